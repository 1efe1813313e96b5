"""Repair of conversations against plain dynamic programming, in one range, over many ranges and segments, and the cases of the docstring."""

import hashlib
import random
import re
import zlib

import pytest

from spanforge.llm import conversation_repair as cr
from spanforge.llm.common import table

SF = "/root/testdata/sf0.001"
PATTERN = re.compile("(s?(ua)+)?")


def best(codes):
    """Least (cost, letters, actions) by dynamic programming over rows and states; no more than two insertions in a row can help."""
    def spread(layer):
        for _ in range(2):
            for q, (cost, letters, made) in list(layer.items()):
                to = cr.NEXT[q]
                new = (cost + 3, letters + "I", [*made, (None, "user" if to == 2 else "assistant")])
                layer[to] = min(layer.get(to, new), new, key=lambda x: x[:2])
        return layer

    layer = spread({0: (0, "", [])})
    for i, (initial, fault) in enumerate(codes):
        new = {}
        for q, (cost, letters, made) in layer.items():
            extra = 3 * (fault == "truncated")
            ways = [("D", 4, q, [])]
            if fault not in ("blank", "duplicate"):
                name = "assistant" if q == 2 else "user"
                ways.append(("R", 3 + extra, cr.NEXT[q], [(i, name)]))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, q))
                if to:
                    ways.append(("K", extra, to, [(i, None)]))
            for letter, c, to, did in ways:
                way = (cost + c, letters + letter, made + did)
                new[to] = min(new.get(to, way), way, key=lambda x: x[:2])
        layer = spread(new)
    return min((layer[q] for q in (0, 3) if q in layer), key=lambda x: x[:2])


def plain(rows):
    """conversations rows (conv_id, turn, role, text); the results by conversation."""
    found = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            found[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, own in found.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        codes, seen = [], set()
        for _, role, text in own:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            codes.append((role[:1], "blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        cost, letters, made = best(codes)
        lines = [f"{name or own[i][1]}:{own[i][2]}" if i is not None else f"{name}:" for i, name in made]
        assert PATTERN.fullmatch("".join(x[:1] for x in lines))
        turns = {t for t, _, _ in own if t is not None}
        out[c] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f == x for _, f in codes) for x in ("blank", "duplicate", "truncated")),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:], strict=False)), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def codes(rng, n):
    return [(rng.choice("suasuaax "), rng.choice(["", "", "", "", "blank", "duplicate", "truncated"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_letters_are_the_least_of_the_cheapest(seed):
    rng = random.Random(seed)
    for _ in range(150):
        own = codes(rng, rng.choice([0, 1, 2, 3, 5, 8, 20]))
        assert cr.solve(own) == best(own)[:2]


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_segments_put_together(monkeypatch, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(40):
        own = codes(rng, rng.choice([5, 9, 40, 130]))
        assert cr.solve(own) == best(own)[:2]


def test_prices_are_distances():
    rng = random.Random(5)
    for _ in range(50):
        own = codes(rng, 12)
        arcs, prices = cr.lattice(own, (0, 3))
        cr.auction(arcs, prices, 0)
        assert prices[0] == best(own)[0]
        assert all(prices[i] <= cost + prices[j] for i, near in enumerate(arcs) for _, cost, j in near)


def made_up(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \n", "What? ", "long " * 50 + "!", None, "é日.", "end.\x0b"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "sudo"]
    return [
        (c, rng.choice([t, t, t, None, t // 2]), rng.choice(roles), rng.choice([*texts, f"text {t}.", f"text {t} of {c}!"]))
        for c in [None, *range(conversations)] for t in range(rng.randrange(most))
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("most_rows", "segment", "parts"), [(4096, 64, 3), (4, 3, 7), (1, 1, 40)])
def test_same_as_plain_python(spark, most_rows, segment, parts):
    rows = made_up(parts, 60, 14)
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert result(cr.repaired(cr.damaged(spark.createDataFrame(rows, SCHEMA)), most_rows=most_rows, segment=segment)) == plain(rows)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(1)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Text {t}.", "open"])) for t in range(700)] + made_up(2, 5, 6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(cr.repaired(cr.damaged(spark.createDataFrame(rows, SCHEMA)), most_rows=100)) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeated_rows_dropped_conversations_and_columns(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "x.")] * 3 + [(-1, 5, "user", "Same text.")] * 4
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", _key int, `odd.name` int")
    found = result(cr.repaired(cr.damaged(df)))
    assert found == plain(rows)
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert cr.repaired(cr.damaged(df.limit(0))).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(cr.op11_conversation_repair(spark, SF)) == plain(rows)
