import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import bpe, queries
from tidewatch.llm.queries import tokenizer_path

from .helpers import ODD, SF, documents, table

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    encoding = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    return lambda text: encoding.encode_ordinary(text or "")


def slow_merge(word, ranks):
    """The definition: merge the leftmost pair of the lowest rank until no pair is in the vocabulary."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def small_ranks(rnd):
    """A vocabulary in which later merges can have lower ranks than the merges that make them possible."""
    tokens = [bytes([b]) for b in range(256)]
    more = {bytes(rnd.choices(b"abc", k=rnd.randint(2, 5))) for _ in range(60)}
    order = list(more)
    rnd.shuffle(order)
    return {t: i for i, t in enumerate(tokens + order)}


def test_query_equals_tiktoken(spark, plain):
    got = {r.doc_id: r for r in queries.REGISTRY["op13_bpe"](spark, SF).collect()}
    rows = table(spark, "documents").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = plain(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@pytest.mark.parametrize("chunk_bytes,task_words", [(1, 1 << 20), (1, 5), (300, 1), (1 << 20, 1 << 20)])
def test_odd_texts(spark, plain, chunk_bytes, task_words):
    texts = [t for _, t in ODD] + ["a\r\n\tb   c  ", "it's WE'LL 1234 x<|endoftext|>y", "\x00\x7f\u2028\u00a0 x", "日本語 привет \U0001f600\u200d" * 3,
                                    "ab" * 3000, "".join(random.Random(1).choices("abcdefgh", k=5000)), "é" * 127, "é" * 128, "é" * 129, " " * 3000 + "x"]
    docs = documents(spark, list(enumerate(texts)), extra=True).withColumns({c: F.lit(1) for c in ("words", "ids", "keys", "rows", "_t", "_text")})
    got = bpe.encode(docs, PATH, PATTERN, chunk_bytes=chunk_bytes, task_words=task_words)
    rows = got.withColumn("bytes", bpe.decode(F.col("ids"), PATH)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == plain(texts[r.doc_id]), r.doc_id
        assert bytes(r.packed) == np.array(r.ids, "<u4").tobytes()
        assert bytes(r.bytes) == (texts[r.doc_id] or "").encode()


def test_merge_order_of_any_vocabulary(spark):
    rnd = random.Random(11)
    for buckets in (1, 97):
        ranks = small_ranks(rnd)
        words = [bytes(rnd.choices(b"abcd", k=rnd.randint(1, 14))) for _ in range(300)] + [b""]
        expected = [slow_merge(w, ranks) if w else [] for w in words]
        assert [bpe.merge_long(w, ranks) if w else [] for w in words] == expected
        chunk = spark.createDataFrame([(words,)], "words array<binary>")
        assert bpe.encode_words(chunk, ranks, buckets).first().ids == expected


def test_any_ids_decode_and_keep_columns(spark, scratch):
    ranks = small_ranks(random.Random(2))
    path = f"{scratch}/ranks"
    with open(path, "wb") as f:
        f.writelines(base64.b64encode(t) + b" " + str(i).encode() + b"\n" for t, i in ranks.items())
    ids = spark.createDataFrame([([255, 0, 260],), ([],), (None,)], "ids array<int>")
    by_id = {i: t for t, i in ranks.items()}
    got = [r.b for r in ids.select(bpe.decode(F.col("ids"), path).alias("b")).collect()]
    assert [None if b is None else bytes(b) for b in got] == [by_id[255] + by_id[0] + by_id[260], b"", None]
    rows = bpe.encode(documents(spark, [(1, "abcabc"), (1, "abcabc"), (None, None)]), path, r"\S+", keep=["doc_id", "lang"]).collect()
    assert sorted((str(r.doc_id), r.lang, r.ids) for r in rows) == sorted([("1", "en", slow_merge(b"abcabc", ranks))] * 2 + [("None", "en", [])])
    with open(path, "wb") as f:
        f.write(b"YQ== 0\n")
    bpe.read_ranks.cache_clear()
    with pytest.raises(ValueError):
        bpe.read_ranks(path)


@pytest.mark.parametrize("most,task_words", [(3, 1 << 20), (1000, 1 << 20), (1000, 1)])
def test_frequent_words_are_encoded_once(spark, plain, most, task_words):
    rnd = random.Random(5)
    often = ["the", " often", " repeated", " wörter", " " * 70, "x" * 80]
    texts = ["".join(rnd.choices(often, k=30)) + " " + "".join(rnd.choices("abcdefgh", k=12)) for _ in range(60)] + [None, ""]
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    common = bpe.common_words(docs.select(F.col("text").alias("_text")), bpe.read_ranks(PATH), PATTERN, most, 4000)
    assert 0 < len(common.words) <= most and common.sizes.sum() == len(common.ids)
    assert all(0 < len(w.encode()) <= bpe.FOLD_BYTES for w in common.words)
    ids = np.split(common.ids, np.cumsum(common.sizes)[:-1])
    assert [list(i) for i in ids] == [plain(w) for w in common.words]
    got = bpe.encode(docs, PATH, PATTERN, chunk_bytes=500, task_words=task_words, most_common=most, counted_bytes=4000)
    # no frequent word is left to the fold of a task
    folded = got.sparkSession.sparkContext.broadcast(common.words)
    split = docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(
        bpe._split(PATTERN, 500, task_words, ["doc_id"], folded),
        "keys array<struct<doc_id: bigint>>, rows array<binary>, words array<binary>, long_words array<binary>, anew boolean")
    left = {bytes(w).decode() for r in split.select("words").collect() for w in r.words}
    assert left and not left & set(common.words)
    assert {r.doc_id: r.ids for r in got.collect()} == {k: plain(t) for k, t in enumerate(texts)}


def test_empty_table(spark):
    assert bpe.encode(documents(spark, []), PATH, PATTERN).collect() == []
