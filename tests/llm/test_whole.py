"""Results that an earlier round cut short."""

import numpy as np

from ledgerline.llm import language_id, minhash, pii
from ledgerline.llm import queries as llm_queries


def low_bits(text):
    return {int(x) >> 32 & 63 for x in minhash.shingle_sets([text.encode()])[0]}


def short_family(f):
    """A has 3 shingles, B one more, whose hash lies 32 mod 64 from one of them: a link at exactly 3/4. Closer texts of
    smaller id lead the buckets of B, and others those of A."""
    words = [f"f{f}w{i}" for i in range(7)]
    a = " ".join(words)
    of_a = low_bits(a)
    for i in range(2000):
        b = f"{a} f{f}y{i}"
        last = low_bits(" ".join(b.split()[-5:])).pop()
        if (last ^ 32) in of_a and last not in of_a:
            break
    return [f"{a} f{f}m{i} f{f}n{i}" for i in range(60)] + [f"{b} f{f}l{i}" for i in range(8)] + [a, b]


def test_minhash_links_short_texts_in_crowded_buckets(spark):
    rng = np.random.default_rng(3)
    texts = [t for f in (1, 5, 6) for t in short_family(f)]
    for k in range(120):
        n = int(rng.integers(5, 16))
        w = [f"r{i}" for i in range(n)]
        if k % 2:
            w[rng.integers(0, n)] = f"e{rng.integers(0, 4)}"
        texts.append(" ".join(w))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(a & b) >= 75 * len(a | b)]
    for _ in texts:
        before = list(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == label


def test_second_estimate_does_not_hang_on_low_bits():
    rng = np.random.default_rng(7)
    for _ in range(5):
        b = rng.integers(0, 1 << 62, 88, dtype=np.uint64)
        b[66:] = b[:22] ^ np.uint64(32 << 32)
        b[:66] &= ~np.uint64(63 << 32)
        b[66:] = (b[66:] & ~np.uint64(63 << 32)) | np.uint64(32 << 32)
        p, q = minhash.fine_bits(b[:66]), minhash.fine_bits(b)
        unequal = int(np.unpackbits((p ^ q).view(np.uint8)).sum())
        assert 1 - unequal * 2 / minhash.FINE >= minhash.FINE_MARGIN


def test_pii_is_inferred_without_base_spans(spark):
    letters = "abcdefghijklmnopqrst"
    known = [(i, f"Write to {letters[i % 20]}{letters[i // 20]}ob@x.example.com or +1 (499) 555-6{i:03d}, in all {i}.") for i in range(300)]
    said = "bob[at]y.example.com"
    rows = [(1000, f"Ask {said} today. Later {said} again."), (1001, " then ".join(["call (812) 444-1234"] * 10)), (1002, "Version 3 of 2024 and 17 others"), (1003, "no candidate"), (1004, None)]
    df = spark.createDataFrame(known + rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(df, pii.fit(df)).collect()}
    kinds = {i: [s.split(":")[0] for s in got[i].spans.split(",") if s] for i in got}
    assert all(got[i].base == "" for i, _ in rows)
    assert kinds[1000] == ["email"] * 2 and kinds[1001] == ["phone"] * 10 and kinds[1002] == kinds[1003] == kinds[1004] == []
    alone = {r.doc_id: r.spans for r in pii.find_personal_data(df.filter("doc_id >= 1000"), pii.fit(df)).collect()}
    assert alone == {i: got[i].spans for i, _ in rows}


def test_languages_have_no_cap_and_none_is_defined(spark, tmp_path):
    rows = [(i, f"wort{chr(97 + i % 26)}{chr(97 + i // 26)} " * 5, f"l{i:03d}") for i in range(205)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.learned(df)
    assert len(model.languages) == 205 and language_id.identify(df, model).filter("lang_pred = 'und'").count() == 0
    df.withColumn("lang", df["lang"].substr(9, 1)).selectExpr("doc_id", "text", "nullif(lang, '') AS lang").write.parquet(f"{tmp_path}/documents.parquet")
    got = llm_queries.op10_language_id(spark, str(tmp_path)).collect()
    assert len(got) == 205 and {(r.lang_pred, r.score, r.rejected, r.entropy) for r in got} == {("und", 0.0, True, None)}
