"""Perspective rotation against a plain version, on odd conversations."""

from collections import defaultdict

import pytest

from searchmill.llm import perspectives
from searchmill.llm.perspectives import rotate_perspectives

SCHEMA = "conv_id long, turn long, role string, text string, position string, name int"


def plain(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append((turn is not None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        for me in {t[2] for t in turns} - {"system"}:
            whole, masks = "", []
            for _, _, role, text in turns:
                if role == me:
                    head = "<|assistant|>\n"
                elif role == "system":
                    head = "<|system|>\n"
                else:
                    head = f"<|user|> {role}\n"
                if role == me:
                    masks.append((len(whole) + len(head), text))
                whole += head + text + "<|end|>\n"
            out[conv, me] = (whole, masks)
    return out


ROWS = [
    (1, 0, "system", "be good", "x", 1),
    (1, 1, "ann", "hi", "x", 2),
    (1, 2, "bob", "", None, 3),
    (1, 2, "bob", "", None, 3),
    (1, 3, "ann", None, None, None),
    (1, 700, "çé", "é" * 3000, None, None),
    (1, 701, "ann", "end\n", None, None),
    (2, 0, "system", "alone", None, None),
    (3, None, None, "who", None, None),
    (3, 0, "ann", "me", None, None),
    (None, 5, "ann", "lost", None, None),
]


@pytest.mark.parametrize("block", [1, 2, 256])
def test_whole_dialogues(spark, block):
    rows = rotate_perspectives(spark.createDataFrame(ROWS, SCHEMA), block).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.conv_id, r.perspective].append(r)
    want = plain(ROWS)
    assert set(got) == set(want)
    for key, turns in got.items():
        turns.sort(key=lambda r: r.position)
        assert [r.position for r in turns] == list(range(len(turns)))
        whole = "".join(r.rendered for r in turns)
        assert whole == want[key][0]
        masks = [r for r in turns if r.role == "assistant"]
        assert [(r.mask_start, whole[r.mask_start : r.mask_end]) for r in masks] == [
            (at, text + "<|end|>") for at, text in want[key][1]
        ]
        assert all(whole[r.start :].startswith(r.rendered) for r in turns)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rotate_perspectives(empty).collect() == []


def test_crowded_blocks_are_cut(spark):
    """Null turns, a null conversation that restarts and copies of one turn: no large group."""
    rows = [(1, None, f"s{k % 3}", f"text {k * 7919 % 700}", None, None) for k in range(700)]
    rows += [(None, k % 5, "ann", f"{k % 97}", None, None) for k in range(500)]
    rows += [(2, 3, "bob", "same", None, None)] * 400
    rows += [(2, 2, "ann", "a", None, None), (2, 4, "ann", None, None, None)]
    rows += [(4, k, "cy", "few", None, None) for k in range(20)] + ROWS
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        cut = perspectives.cut_blocks(perspectives.block_rows(turns), 50)
        largest = cut.groupBy("conv", "no_conv", "block", "cut").count().agg({"count": "max"}).first()[0]
        assert cut.count() == len(rows) and largest <= 150
        assert_whole(rotate_perspectives(turns, most=50).collect(), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def assert_whole(done, rows):
    got = defaultdict(list)
    for r in done:
        got[r.conv_id, r.perspective].append(r)
    want = plain(rows)
    assert set(got) == set(want)
    for key, turns in got.items():
        turns.sort(key=lambda r: r.position)
        assert [r.position for r in turns] == list(range(len(turns)))
        whole = "".join(r.rendered for r in turns)
        assert whole == want[key][0]
        at = 0
        for r in turns:
            assert r.start == at
            at += len(r.rendered)
        assert [r.mask_start for r in turns if r.role == "assistant"] == [a for a, _ in want[key][1]]
