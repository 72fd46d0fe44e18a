import zlib

import numpy as np
import pytest

from tidewatch.llm import packing
from tidewatch.llm.queries import tokenizer_path

from .helpers import ODD, documents, table

tokenizers = pytest.importorskip("tokenizers")


def ids_of(texts):
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in texts]


def check(rows, expected):
    """Round trip: the pieces are the documents' ids, and every sequence is gapless and a power of two long."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(expected)
    for doc_id, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(expected[doc_id])
            assert r.ids_crc32 == zlib.crc32(expected[doc_id][at:at + r.length].tobytes())
            at += r.length
        assert at == len(expected[doc_id])
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0


@pytest.mark.parametrize("group_rows", [7, 20_000])
def test_round_trip(spark, group_rows):
    docs = table(spark, "documents")
    rows = docs.select("doc_id", "text").collect()
    expected = dict(zip([r.doc_id for r in rows], ids_of([r.text for r in rows])))
    check(packing.pack(docs, tokenizer_path(), group_rows=group_rows).collect(), expected)


def test_odd_rows_and_special_strings(spark):
    odd = [(k, t) for k, (_, t) in enumerate(ODD)] + [(90, "end <|endoftext|> of it"), (91, "  tab\t\t  two  \n\n"), (92, "it's we'll 123,456"), (93, " " * 1_500_000 + "x")]
    rows = packing.pack(documents(spark, odd, extra=True), tokenizer_path()).collect()
    check(rows, dict(zip([k for k, _ in odd], ids_of([t for _, t in odd]))))


def test_repeated_rows_are_documents_of_their_own(spark):
    rows = packing.pack(documents(spark, [(1, "a b c")] * 5 + [(None, "a b c")] * 2), tokenizer_path()).collect()
    assert sum(r.length for r in rows) == 7 * rows[0].doc_tokens
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), tokenizer_path()).collect() == []
