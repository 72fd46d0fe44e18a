import hashlib

from tidewatch.llm import winnow

from .helpers import ODD, documents, table

BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def gram_hash(codes):
    h = 0
    for c in codes:
        h = (h * BASE + c + 1) & MASK
    h ^= h >> 29
    h = h * 0xBF58476D1CE4E5B9 & MASK
    return (h ^ h >> 32) >> 24


def brute(text, gram, window):
    codes = [ord(c) for c in text]
    if not codes:
        return []
    if len(codes) < gram:
        return [(gram_hash(codes), 0)]
    hashes = [gram_hash(codes[i:i + gram]) for i in range(len(codes) - gram + 1)]
    window, out = min(window, len(hashes)), []
    for i in range(len(hashes) - window + 1):
        low = min(hashes[i:i + window])
        at = max(j for j in range(i, i + window) if hashes[j] == low)
        if not out or out[-1][1] != at:
            out.append((low, at))
    return out


def test_selection_against_brute_force(monkeypatch):
    texts = ["", "a", "ab" * 40, "é" * 300, "the quick brown fox jumps over the lazy dog " * 9, "x" * 64, "𝒳y" * 100]
    for chunk in (1 << 20, 32):
        monkeypatch.setattr(winnow, "_CHUNK", chunk)
        for text in texts:
            for gram, window in ((25, 40), (5, 4), (8, 1), (3, 7)):
                hashes, at = winnow.select(text, gram, window)
                assert list(zip(hashes.tolist(), at.tolist())) == brute(text, gram, window)


def test_match_guarantee():
    shared = "a passage of at least window plus k minus one code points, shared by both."
    assert len(shared) >= winnow.GRAM + winnow.WINDOW - 1
    one, two = (set(winnow.select(t)[0].tolist()) for t in ("x" * 200 + shared + "y" * 90, "other words " * 30 + shared + "end"))
    assert one & two


def test_edited_likeness_against_brute_force(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in winnow.edited_likeness(docs, 64).collect()}
    assert set(found) == set(texts)
    for i, k in enumerate(order):
        own, follow = texts[k], texts[order[(i + 1) % len(order)]]
        half = len(own) // 2
        edited = own[:len(own) - half] + follow[:half]
        r = found[k]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if i % 20 == 0:
            prints = [brute(t, winnow.GRAM, winnow.WINDOW) for t in (own, edited, follow)]
            a, b, c = ({h for h, _ in p} for p in prints)
            text = ["".join("%010x%06x" % (h, at) for h, at in p) for p in prints]
            assert [r.fingerprint, r.edited_fingerprint] == text[:2]
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 1e-12 and abs(r.near_next - len(a & c) / len(a | c)) < 1e-12


def test_odd_rows(spark):
    for buckets in (2, 64):
        found = winnow.edited_likeness(documents(spark, ODD, extra=True), buckets).collect()
        assert len(found) == len(ODD)
        by_id = {r.doc_id: r for r in found}
        # without an id: last; the next one is the first, id 10
        edited = "a row without an id"[:10] + "long text of many words "[:9]
        assert by_id[None].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_id[1].n_chars == 0 and by_id[1].fingerprint == "" and by_id[2].near_next == 1.0
        assert by_id[4].fingerprint == by_id[5].fingerprint


def test_single_and_no_document(spark):
    row = winnow.edited_likeness(documents(spark, [(3, "just this one text")]), 64).collect()
    assert [(r.doc_id, r.near_next) for r in row] == [(3, 1.0)]
    assert winnow.edited_likeness(documents(spark, []), 64).collect() == []


def test_fingerprints_keep_positions(spark):
    r = winnow.fingerprints(documents(spark, [(1, "the quick brown fox jumps over the lazy dog " * 9)]), 5, 4).collect()[0]
    assert list(zip(r.hashes, r.positions)) == brute("the quick brown fox jumps over the lazy dog " * 9, 5, 4)
