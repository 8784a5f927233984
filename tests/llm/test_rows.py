"""Decisions by row, and classes of all code points."""

import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from voxgraph.llm import bpe, decontam

PATH = public_tokenizers.path("byte_bpe_50k.json")
ITEM = "one two three four five six seven eight nine ten eleven"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, contaminated boolean, gate long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1, True, 2) for i, t in rows], SCHEMA)


ROWS = [(None, f"a b {ITEM}"), (7, ITEM.upper()), (7, "a clean text under that id"), (8, "a clean text"), (8, "a clean text"), (9, None), (10, ""), (None, "clean too"), (11, "x " * 40_000 + ITEM), (12, ITEM[:-20])]
CLEAN = sorted(ROWS[2:8] + ROWS[9:], key=repr)


@pytest.mark.parametrize("sent", [10_000, 0])
def test_rows_are_judged_alone(spark, sent):
    """A hit row without an id goes, a clean row that shares the id of a hit one stays, on both paths, with all columns."""
    items = spark.createDataFrame([("i", ITEM), (None, "a clean text"), ("j", None)], "item_id string, text string")
    table = docs(spark, ROWS)
    got = decontam.clean(table, items, broadcast_windows=sent)
    assert got.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == CLEAN
    judged = {(r.doc_id, r.n_hit, r.contaminated) for r in decontam.decontaminate(table, items, broadcast_windows=sent).collect()}
    assert {(None, 11, True), (7, 11, True), (7, 0, False), (8, 0, False), (None, 0, False), (11, 11, True), (12, 0, False)} <= judged
    assert decontam.clean(docs(spark, []), items, broadcast_windows=sent).count() == 0
    assert decontam.clean(table, items.limit(0), broadcast_windows=sent).count() == len(ROWS)


def test_benchmark_stage_by_value(spark, tmp_path):
    spark.createDataFrame([("i", ITEM)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)["benchmark"]
    got = stage(spark, docs(spark, ROWS), str(tmp_path))
    assert tuple(got.columns) == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == CLEAN


def test_near_duplicate_stage_by_value(spark):
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, long), (3, long + " more"), (None, long), (3, "another text"), (6, None), (7, ""), (7, ""), (9, "short")]
    got = sorted(((r.doc_id, r.text) for r in stage(spark, docs(spark, rows), "").collect()), key=repr)
    assert got == sorted([r for r in rows if r[0] != 5], key=repr)
    assert stage(spark, docs(spark, []), "").count() == 0


def test_every_code_point_has_the_library_s_class():
    """After a letter, after a number, after a space and alone."""
    library, own = Tokenizer.from_file(PATH), bpe.load(PATH)
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}\n" for c in points[at : at + 20_000])
        assert own.ids(text) == library.encode(text, add_special_tokens=False).ids
    own.cache.clear()
