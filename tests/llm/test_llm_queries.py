import os

import pytest

import __spark_entry__ as entry
from almazara.llm import queries, tokens

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs_with_a_stable_schema(spark, name):
    q = entry.queries()[name]
    a, b = q(spark, DATA), q(spark, DATA)
    assert a.schema == b.schema and a.count() == b.count()


@pytest.mark.skipif(not os.path.exists(tokens.TOKENIZER), reason="no tokenizer")
def test_sizes_are_round_trips(spark):
    texts = ["El gobierno examinó  el marco.", "", None, "a" * 50_000, "<|endoftext|>", " \n "]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s")], "doc_id int, text string, source string")
    rows = tokens.token_sizes(df).collect()
    encode = tokens.encoder(tokens.TOKENIZER)
    assert sorted(r.doc_id for r in rows) == [0, 0, 3, 4, 5] and len({r.item_id for r in rows}) == 5
    for r in rows:
        ids = encode.encode_ordinary(texts[r.doc_id])
        assert r.tokens == len(ids) and encode.decode(ids) == texts[r.doc_id]
