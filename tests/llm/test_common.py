"""What tasks leave behind in the Python workers that later tasks use again."""

import sys

import public_tokenizers
import pyarrow as pa
import pytest

from tonetape.llm import common
from tonetape.llm.bpe import encoder
from tonetape.llm.jaccard import near_groups
from tonetape.llm.mixing import mixture
from tonetape.llm.packing import pack
from tonetape.llm.tokencount import token_counts
from tonetape.llm.words import powers

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def holding(spark):
    """How many tasks, more than there are workers, find a tokenizer in theirs."""

    def look(batches):
        for _ in batches:
            own = sys.modules.get("tonetape.llm.bpe")
            yield pa.RecordBatch.from_pydict({"n": pa.array([own.encoder.cache_info().currsize if own else 0], pa.int64())})

    return sum(r.n for r in spark.range(0, 64, 1, 64).mapInArrow(look, "n long").collect())


@pytest.mark.parametrize("operator", [mixture, near_groups])
def test_tokenizers_do_not_stay_under_other_operators(spark, operator):
    """The pipeline's workers held them, with all words they knew, in the stages of the next run: 3,024 MB of an executor in mixing."""
    texts = "concat('one two three four five six seven ', id) AS text"
    docs = spark.range(640).selectExpr("id AS doc_id", texts, "'src' AS source").repartition(64).localCheckpoint()
    token_counts(docs, TOKENIZER).collect()
    assert holding(spark) > 0
    assert len(operator(docs).collect()) == 640
    assert holding(spark) == 0


def test_frugal_keeps_what_it_is_told(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"a": [1, 2]}), pa.RecordBatch.from_pydict({"a": [3]})]
    encoder(TOKENIZER), powers(16)
    assert list(common.frugal(iter, encoder)(iter(batches))) == batches
    assert encoder.cache_info().currsize and not powers.cache_info().currsize
    assert list(common.frugal(iter)(iter(batches))) == batches
    assert not encoder.cache_info().currsize

    def fails(_):
        encoder(TOKENIZER)
        yield batches[0]
        raise ValueError("in a task")

    with pytest.raises(ValueError):
        list(common.frugal(fails)(iter(batches)))
    assert not encoder.cache_info().currsize


def test_texts_go_to_python_in_small_batches(spark):
    """10,000 texts at once were held whole by a worker, and packing took more than 3,000 MB of an executor."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    table = common.written_texts(spark.range(0, 2_500, 1, 1).mapInArrow(sizes, "n long"), "sizes")
    assert sorted(r.n for r in table.collect()) == [500, 1_000, 1_000]
    assert spark.conf.get(key) == before
    with common.batches_of(spark, 10), common.batches_of(spark, 1_000):
        assert spark.conf.get(key) == "10"


def test_packing_without_keeping_the_tokenizer(spark):
    """The pieces are the same whether workers keep it or not."""
    texts = "concat(repeat('one two three ', id % 9), id) AS text"
    docs = spark.range(0, 300, 1, 2).selectExpr("id AS doc_id", texts)
    pieces = [sorted(map(tuple, pack(docs, TOKENIZER, window=64, keep_tokenizer=k).collect())) for k in (True, False)]
    assert pieces[0] == pieces[1]
