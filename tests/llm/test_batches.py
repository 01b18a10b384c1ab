"""Steps over texts hand them to Python tasks in batches bounded by bytes, not by rows alone."""

import pyarrow as pa
import pytest

import corpus_pipeline
from courtlens.llm import common, decontaminate, dedup_substrings, simhash, toxicity

ROWS = 300
SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def docs(spark):
    """One partition of about 6 MB in fewer rows than a batch may have; neighbours share passages."""
    words = [f"word{i % 977} of{i % 89} text{i % 613}" for i in range(4 * ROWS)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 30]) + f" end{i} " + "filling " * 2500) for i in range(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


@pytest.fixture
def items(spark):
    return spark.createDataFrame([("a", "one two three four five six seven eight nine ten")], "item_id string, text string")


def counted(spark, monkeypatch, module):
    """How many batches ``module`` gets."""
    seen, plain = spark.sparkContext.accumulator(0), module.chunks

    def chunks(batch, *names):
        seen.add(1)
        return plain(batch, *names)

    monkeypatch.setattr(module, "chunks", chunks)
    return seen


def test_decontamination_reads_bounded_batches(spark, monkeypatch, docs, items):
    seen = counted(spark, monkeypatch, decontaminate)
    assert decontaminate.decontaminate(docs, items).count() == ROWS
    # Two batches for the item, one a partition of its windows; by rows there was one for the documents.
    assert seen.value >= 2 + 6_000_000 // common.BATCH_BYTES


def test_fingerprints_of_passages_read_bounded_batches(spark, monkeypatch, docs):
    seen = counted(spark, monkeypatch, dedup_substrings)
    dedup_substrings.repeated_spans(common.keyed(docs, "doc_id", "text"))
    # Three passes over the texts at least; by rows one batch each.
    assert seen.value >= 3 * (6_000_000 // common.BATCH_BYTES)


def test_character_model_reads_bounded_batches(spark, monkeypatch, docs):
    seen = counted(spark, monkeypatch, toxicity)
    toxicity.character_model(common.keyed(docs, "doc_id", "text"))
    assert seen.value >= 6_000_000 // common.BATCH_BYTES


def test_bounded_batches_hold_about_so_many_bytes_and_every_row(spark, docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["rows", "bytes"]
            )

    rows = common.store_texts(docs.mapInArrow(sizes, "rows bigint, bytes bigint"), "sizes").collect()
    assert sum(r["rows"] for r in rows) == ROWS
    assert max(r["bytes"] for r in rows) < 2 * common.BATCH_BYTES


@pytest.mark.parametrize("own", [None, "12345678"])
def test_the_setting_of_the_session_comes_back(spark, own):
    before = spark.conf.get(SETTING, None)
    try:
        spark.conf.unset(SETTING) if own is None else spark.conf.set(SETTING, own)
        with pytest.raises(ZeroDivisionError), common.bounded_batches(spark):
            assert spark.conf.get(SETTING) == str(common.BATCH_BYTES)
            raise ZeroDivisionError
        assert spark.conf.get(SETTING, None) == own
    finally:
        spark.conf.unset(SETTING) if before is None else spark.conf.set(SETTING, before)


def test_pipeline_tokens_and_fingerprints_run_inside_the_bound(spark, monkeypatch, docs):
    held = []
    for module in (simhash, corpus_pipeline):
        plain = module.store_texts

        def noted(df, name, plain=plain):
            held.append(name)
            return plain(df, name)

        monkeypatch.setattr(module, "store_texts", noted)
    simhash.near_duplicates(docs.limit(3))
    assert corpus_pipeline.tokens(spark, docs.limit(3), "").count() == 3
    assert held == ["fingerprints", "tokens"]
