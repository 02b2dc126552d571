"""The corpus pipeline, stage by stage, against the plain versions of its operators."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import test_decontamination
import test_near
import test_repeats
from drover.llm import packing
from drover.llm.decontamination import question_and_answer
from drover.llm.queries import TOKENIZER
from drover.session import stage
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language-id", "near-duplicates", "suffix-repeats", "decontamination", "packing",
    ]


def test_every_stage_like_its_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "", "en", None, 0), (9003, "12 34 !!", None, "s", 8), (None, docs.first()["text"], "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    functions = [f for _, f in corpus_pipeline.STAGES]

    known = stage(functions[0](spark, docs, FOLDER))
    assert known.columns == docs.columns
    gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in known.collect()}
    assert {9001, 9002, 9003} <= gone and len(gone) <= 6

    single = stage(functions[1](spark, known, FOLDER))
    least = {c for _, _, c in test_near.plain(rows_of(known)) if c is not None}
    assert {r["doc_id"] for r in single.collect() if r["doc_id"] is not None} == least
    assert sum(r["doc_id"] is None for r in single.collect()) == 1 and single.columns == docs.columns

    cut = stage(functions[2](spark, single, FOLDER))
    after, before = rows_of(cut), dict(rows_of(single))
    assert Counter(d for d, _ in after) == Counter(before.keys())
    sizes = {d: n - r for d, n, r, _, _ in test_repeats.plain(list(before.items()))}
    for doc_id, text in after:  # whole characters stay, up to three bytes at each end of a span
        assert 0 <= len(text.encode()) - sizes[doc_id] <= 6 * (before[doc_id].count("\n") + 40)
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    clean = stage(functions[3](spark, cut, FOLDER))
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", *question_and_answer("text")).collect()]
    leaked = {d for d, _ in test_decontamination.plain(after, items)}
    assert Counter(rows_of(clean)) == Counter(x for x in after if x[0] not in leaked)

    packed = functions[4](spark, clean, FOLDER)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    expected = Counter()
    for doc_id, text in rows_of(clean):
        expected[(doc_id, len(tokenizer.encode(text, add_special_tokens=False).ids) + 1)] += 1
    whole = Counter()
    for r in packed.collect():
        whole[(r["doc_id"], r["doc_tokens"])] += r["length"]
    assert whole == Counter({k: k[1] * n for k, n in expected.items()})


def test_run_gives_the_last_stage(spark):
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "ids", "length", "sequence_id"} <= set(packed.columns) and packed.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("number", range(5))
def test_stages_of_an_empty_table(spark, number):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[number][1](spark, docs, FOLDER).count() == 0
