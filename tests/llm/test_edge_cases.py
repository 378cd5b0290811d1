"""Every operator on an empty table and on awkward rows."""

import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from trailframe.llm import chat, decontaminate, language, licenses, linededup, mixing, pii, quality, sharding, simhash


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta. Eta theta."), (2, None), (3, "")], "item_id long, text string")


OPERATORS = {
    "licenses": licenses.scan, "sharding": sharding.assign, "pii": pii.report, "quality": quality.report,
    "language": language.identify, "simhash": simhash.near_duplicates, "mixing": mixing.mixture, "linededup": linededup.report}
PER_ROW = ("sharding", "pii", "quality", "language", "simhash", "linededup")


@pytest.mark.parametrize("name", OPERATORS)
def test_empty(documents, name):
    assert OPERATORS[name](documents([])).count() == 0


@pytest.mark.parametrize("name", PER_ROW)
def test_one_answer_per_row(awkward, name):
    assert OPERATORS[name](awkward).count() == awkward.count()


def test_decontamination_edges(documents, awkward, items):
    assert decontaminate.leaks(documents([]), items).count() == 0
    assert decontaminate.leaks(awkward, items).count() == 0
    assert decontaminate.leaks(awkward, items.limit(0)).count() == 0
    assert decontaminate.keep_clean(awkward, items).columns == awkward.columns
    assert decontaminate.keep_clean(awkward, items).count() == awkward.count()


def test_chat_edges(spark):
    rows = [(1, 0, None, "hi"), (1, 0, "user", None), (1, None, "assistant", "x<\\g"), (None, 1, "user", "a"), (1, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 as slot", "2 as seq")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got[1]["n_turns"] == 4 and got[None]["n_turns"] == 1 and got[1]["loss_chars"] == 4
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_scan_edges(awkward):
    assert licenses.scan(awkward).count() == 0


def test_mixture_edges(awkward):
    got = mixing.mixture(awkward, fraction=1.0).collect()
    assert got and all(r["epoch"] in (0, 1) for r in got)


@pytest.mark.parametrize("stage", range(4))
def test_stages_return_document_columns(awkward, items, spark, tmp_path, stage):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.STAGES[stage][1](spark, awkward, str(tmp_path))
    assert out.columns == awkward.columns
    out.collect()
    assert corpus_pipeline.STAGES[stage][1](spark, awkward.limit(0), str(tmp_path)).count() == 0


def test_last_stage(awkward, spark, tmp_path):
    assert corpus_pipeline.shards(spark, awkward, str(tmp_path)).count() == awkward.count()


def test_one_of_each_group_stays(awkward):
    kept = [r["doc_id"] for r in simhash.keep_one(awkward).select("doc_id").collect()]
    assert sorted(x for x in kept if x is not None) == [1, 4, 6, 7, 8, 9]


def test_rows_without_an_id_or_with_a_repeated_one_stay(documents):
    texts = [prose(60 + k, 80) for k in range(4)]
    ids = [None, None, None, 5, 5, 5, None]
    rows = [(i, texts[k], "en", "a") for i, k in zip(ids, [0, 1, 0, 2, 3, 0, 3], strict=True)]
    kept = simhash.keep_one(documents(rows)).select("doc_id", "text").collect()
    assert sorted(r["text"] for r in kept) == sorted(texts)
    assert {r["text"]: r["doc_id"] for r in kept} == {texts[0]: 5, texts[1]: None, texts[2]: 5, texts[3]: 5}
