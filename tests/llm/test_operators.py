"""Each operator on nulls, empty texts, repeats, clashing columns and empty tables, and against brute force."""

import hashlib
import re
from array import array
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerline.llm import bpe, common, exact_dedup, language_id, licenses, minhash, mixing, pii, quality, sharding, substring_dedup, words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, __id string, kept string"
LONG = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, None, "en", "a", 0, "x", "y"), (2, "", None, None, 0, "x", "y"), (3, LONG, "en", "a", 1, None, None), (4, LONG.upper(), "en", "a", 1, "x", "y"), (5, LONG + " tail one two", "en", "b", 1, "x", "y"),
    (6, " \t\n ", "fr", "b", 1, "x", "y"), (7, "éa " * 5000, "fr", "b", 1, "x", "y"), (8, "same text", "fr", "a", 1, "x", "y"), (8, "same text", "fr", "a", 1, "x", "y"), (9, "Mail bob@x.example.com or +1 (499) 555-6503, later (499) 555-6503", "en", "a", 1, "x", "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def norm(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


def test_bpe_equals_tiktoken_and_round_trips(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    made = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    back = bpe.decode_documents(made, path).collect()
    texts = {r[0]: r[1] or "" for r in ROWS}
    assert len(back) == len(ROWS)
    for r in back:
        assert list(array("I", r.ids)) == enc.encode_ordinary(texts[r.doc_id]) and r.text == texts[r.doc_id]
    assert bpe.token_digests(empty, path, public_tokenizers.PATTERN).count() == 0


def test_long_pieces_emit_sure_tokens_by_block(monkeypatch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rules = bpe.Transducer(bpe.read_ranks(path))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rules.ranks, special_tokens={})
    monkeypatch.setattr(bpe, "BLOCK", 7)
    monkeypatch.setattr(bpe, "STATES_KEPT", 50)
    for piece in ("a" * 500, "thereinationalization" * 20, "=-" * 300, "éß" * 90, "0123456789" * 30, "t"):
        assert list(array("I", rules.encode(piece.encode()))) == enc.encode_ordinary(piece)


def test_utf8_stream_holds_cut_characters():
    data = "aé漢😀z".encode()
    for size in (1, 2, 3):
        s = bpe.Utf8Stream()
        assert "".join(s.feed(data[i : i + size]) for i in range(0, len(data), size)) + s.finish() == data.decode()
    s = bpe.Utf8Stream()
    assert s.feed(b"\xe2\x82") == "" and s.finish() == "�"


def test_rake_in_spark_equals_numpy_and_meets_margins(spark, docs, empty, monkeypatch):
    rows = mixing.with_cells(docs)
    monkeypatch.setattr(mixing, "SWEEPS", 3)
    a = {(r.source, r.lang, r.topic): r.p for r in mixing.keep_probabilities(rows, budget=0.5).collect()}
    b = {(r.source, r.lang, r.topic): r.p for r in mixing.keep_probabilities(rows, budget=0.5, max_cells=0).collect()}
    monkeypatch.undo()
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-4 for k in a)
    p = mixing.rake(np.array([100.0, 100, 100, 100]), [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])], [np.array([60.0, 120]), np.array([90.0, 90])], 0.5)
    assert abs(p[:2].sum() * 100 - 60) < 1e-3 and abs(p[2:].sum() * 100 - 120) < 1e-3
    assert mixing.mixed(docs).count() == len(ROWS) and mixing.mixed(empty).count() == 0
    kept = mixing.sample_mixture(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in mixing.mixed(docs).filter("kept").collect())


def plain_mixture(rows, budget, power, seed):
    """Raking cell by cell in plain loops: (doc_id, probability, kept) of rows (doc_id, source, lang, topic, tokens)."""
    cells = Counter()
    for _, *cell, n in rows:
        cells[tuple(cell)] += n
    whole, p = sum(cells.values()), dict.fromkeys(cells, budget)
    targets = []
    for m in range(3):
        sums = Counter()
        for c, n in cells.items():
            sums[c[m]] += n
        flat = {v: float(n) ** power for v, n in sums.items()}
        targets.append({v: budget * whole * x / sum(flat.values()) for v, x in flat.items()})
    for _ in range(500):
        before = dict(p)
        for m, target in enumerate(targets):
            now = Counter()
            for c, n in cells.items():
                now[c[m]] += p[c] * n
            p = {c: min(1.0, p[c] * (target[c[m]] / now[c[m]] if now[c[m]] else 1.0)) for c in cells}
        if all(abs(p[c] - before[c]) < 1e-6 for c in p):
            break
    draw = lambda i: int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:13], 16) / 16**13
    return {i: (p[tuple(cell)], draw(i) < p[tuple(cell)]) for i, *cell, _ in rows}


def test_mixture_against_plain_raking(spark, docs):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in mixing.with_cells(d).collect()]
    want, found = plain_mixture(rows, mixing.BUDGET, mixing.FLATTEN, "mix-0"), mixing.mixed(d)
    got = {r.doc_id: (r.probability, r.kept) for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[i][0] - want[i][0]) < 1e-6 and got[i][1] == want[i][1] for i in got)
    report = mixing.margin_report(found).collect()
    for m in mixing.MARGINS:
        part = [r for r in report if r.margin == m]
        assert sum(r.tokens for r in part) == sum(x[-1] for x in rows) and sum(r.kept for r in part) == sum(x[-1] for x in rows if want[x[0]][1])
        assert abs(sum(r.target for r in part) - mixing.BUDGET * sum(x[-1] for x in rows)) < 1e-3
    clash = docs.withColumn("__s", F.lit(1)).withColumn("__p", F.lit(0.0))
    assert mixing.sample_mixture(clash).columns == clash.columns


def test_shards_count_in_longs(spark, docs, empty):
    made = sharding.interleaved_shards(docs)
    assert dict(made.dtypes)["slot"] == "bigint" and sharding.interleaved_shards(empty).count() == 0
    rows = made.collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(ROWS) and all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items()) and max(sizes.values()) - min(sizes.get(s, 0) for s in range(16)) <= 1


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    """Base spans by the patterns as they stand, checks after each leftmost match."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(digits))) % 10 == 0
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0]), s[2]))


def test_pii_base_spans_against_plain_patterns(spark):
    rng = np.random.default_rng(5)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null").select("text").collect()]
    texts += ["".join(rng.choice(list("0123456789.+-() @ab%,\n"), 40)) for _ in range(3000)] + ["1." * 3000, "+1" + "-" * 3000 + "2", "4111111111111111 4111-1111-1111-1111 +44 20 7946 0958 a@b.c.d 1.2.3.4.5.6.7.8"]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t[:200]


def test_pii_sees_all_overlapping_spans():
    text = "1.1.1.1 " * 30
    base = pii.base_spans(text) + [("card", 0, len(text) - 1)]
    spans, labels = pii.labelled_tokens(text, base)
    assert sum(1 for x in labels if x) == len(base)


def test_substring_dedup_against_brute_force(spark, docs, empty):
    base = [f"t{i}" for i in range(300)]
    texts = [" ".join(base), "x y " + " ".join(base[40:100]) + " z", " ".join(["q"] * 80), " ".join(base[:34]), None, "", " ".join(f"u{i}" for i in range(90)), " ".join(base[10:44]) + " end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    split = {i: (t or "").split() for i, t in enumerate(texts)}
    seen = Counter(tuple(w[k : k + 35]) for w in split.values() for k in range(len(w) - 34))
    for r in substring_dedup.remove_repeats(df).collect():
        w = split[r.doc_id]
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    assert substring_dedup.remove_repeats(empty).count() == 0 and substring_dedup.remove_repeats(docs).count() == len(ROWS)


def test_substring_dedup_with_repeated_and_null_ids(spark, monkeypatch):
    base = [f"t{i}" for i in range(70)]
    text = " ".join(base[:50])
    rows = [(3, "q"), (3, text), (None, text), (None, "zz " + text + " yy"), (7, text), (7, text), (8, None), (11, "  " + "\n".join(base[20:70]))]
    split = [(t or "").split() for _, t in rows]
    seen = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    want = []
    for (i, _), w in zip(rows, split):
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        want.append((str(i), len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    monkeypatch.setattr(substring_dedup, "SEEDS_A_SHARD", 2)
    monkeypatch.setattr(substring_dedup, "LOAD_A_TASK", 2)
    for kind in ("bigint", "string"):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
        got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df).collect()]
        assert sorted(got) == sorted(want)


def test_words_of_many_texts():
    texts = [b"", b"  a\tbb ccc", b"a \n\x0b\x1cb  b", b"x" * 500 + b" y", "é 中文字字字字字字字字字字".encode(), b" "]
    found, plain = words.Words(texts), [w for t in texts for w in t.split()]
    assert [found.data[a:b] for a, b in zip(found.starts, found.ends)] == plain
    assert np.diff(found.first).tolist() == [len(t.split()) for t in texts]
    assert len(set(zip(found.hash.tolist(), plain))) == len(set(plain)) == len(set(found.hash.tolist()))


def test_dropping_copies_of_repeated_ids_and_clashing_columns(spark):
    rows = [(5, "a", 1), (7, "A", 2), (5, "b", 3), (None, "c", 4), (None, None, 5), (1, "", 6), (5, "b", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __kept_id bigint")
    assert sorted(map(str, exact_dedup.drop_exact_duplicates(df).collect())) == sorted(map(str, df.filter("__kept_id in (2, 3, 4, 6)").collect()))
    one = "one two three four five six seven eight nine ten eleven twelve"
    near = spark.createDataFrame([(2, one, 1), (3, one + " more", 2), (4, "else", 3), (6, None, 4)], df.schema)
    assert sorted(r.doc_id for r in minhash.drop_near_duplicates(near).collect()) == [2, 4, 6]
    assert exact_dedup.drop_exact_duplicates(df.limit(0)).count() == 0 and minhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_pii_adds_consistent_spans_and_keeps_base(spark, docs, empty):
    found = {r.doc_id: r for r in pii.find_personal_data(docs, pii.fit(docs)).collect()}
    r, text = found[9], ROWS[-1][1]
    spans = [s.split(":") for s in r.spans.split(",")]
    assert (r.n_email, r.n_phone) == (1, 1) and set(r.base.split(",")) <= set(r.spans.split(","))
    assert ("phone", "(499) 555-6503") in [(k, text[int(a) : int(b)]) for k, a, b in spans]
    assert found[1].spans == "" and pii.find_personal_data(empty, pii.fit(empty)).count() == 0


@pytest.mark.parametrize("text,want", [("a@b.c", ["email:0:5"]), ("a@b", []), ("1.2.3.4 256.1.1.1", ["ip:0:7"]), ("4111 1111 1111 1111", ["card:0:19"]), ("4111 1111 1111 1112", []), ("+12345678901", ["phone:0:12"]), ("+1234", []), ("x" * 50000 + "@", [])])
def test_base_spans(text, want):
    assert [":".join(map(str, s)) for s in pii.base_spans(text)] == want


def test_quality_counts(spark, docs, empty):
    rows = [(1, "a b c d e f g h " * 3), (2, None), (3, "the of and\nx y\nthe of and\n\n"), (4, " ".join(f"the w{i}" for i in range(30)))]
    got = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (got[1].n_words, got[1].n_repeat_words, got[1].base_failed) == (24, 24, True) and (got[2].n_words, got[2].kept) == (0, False)
    assert (got[3].n_dup_lines, got[3].n_repeat_words) == (1, 0) and got[4].kept
    assert quality.judged(docs).count() == len(ROWS) and quality.judged(empty).count() == 0


def test_exact_duplicates(spark, docs, empty):
    groups = {}
    for r in ROWS:
        groups.setdefault(norm(r[1]), []).append(r[0])
    for r in exact_dedup.exact_duplicates(docs).collect():
        ids = next(g for g in groups.values() if r.doc_id in g)
        assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), r.doc_id == max(ids))
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_exact_duplicates(docs).columns == docs.columns


def test_minhash_against_brute_force(spark, docs, empty):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 10_000, 200)]
    texts = [" ".join(base)]
    for k in range(40):
        w = list(base)
        for j in rng.integers(0, 200, k // 3 + 1):
            w[j] = f"edit{rng.integers(0, 60)}"
        texts.append(" ".join(w))
    texts += ["one two", "ONE two", None, "", texts[0].upper()]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for w in (norm(t).split() for t in texts)]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label and [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert minhash.near_duplicates(empty).count() == 0 and minhash.near_duplicates(docs).count() == len(ROWS)


def test_shards_match_the_law_and_the_mixture(spark, docs, empty):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "warm").alias("source"))
    rows = sharding.interleaved_shards(df).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    hot = Counter(r.shard for r in rows if r.source == "hot")
    assert max(hot.values()) - min(hot.values()) <= 2
    small = df.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("doc_id").cast("string")))
    hot = Counter(r.shard for r in sharding.interleaved_shards(small).collect() if r.source == "hot")
    assert len(hot) == 16 and min(hot.values()) >= 10
    sql = sharding.PLACES_SQL.replace("FROM documents", "FROM '/root/testdata/sf0.001/documents.parquet'")
    mine = sharding.interleaved_shards(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {(r.doc_id, r["size"], r.shard, r.slot) for r in mine} == {(i, size, shard, slot) for i, size, _, shard, slot, _ in duckdb.sql(sql).fetchall()}
    assert sharding.interleaved_shards(empty).count() == 0 and sharding.interleaved_shards(docs).count() == len(ROWS)


def test_licenses_survive_spelling_case_and_copyright(spark, docs, empty):
    mit = "Copyright (c) 2020 Someone\n\n" + licenses.LICENSES[0][1].replace("sublicense", "sub-licence").upper()
    df = spark.createDataFrame([(1, mit), (2, "Prose.\nReleased under the  MIT Licence.\n"), (3, None), (4, "MIT")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.license_report(df, licenses.known_digests(spark)).collect()}
    assert got[1].whole_license == "MIT" and (got[2].license_ids, got[2].n_units, got[2].whole_license) == ("MIT", 1, None) and got[3].n_units == got[4].n_units == 0
    assert licenses.license_report(empty, licenses.known_digests(spark)).count() == 0 and licenses.license_report(docs, licenses.known_digests(spark)).count() == len(ROWS)


def test_language_held_out_accuracy_and_edges(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.learned(d.filter(~language_id.held_out()))
    got = language_id.identify(d, model).join(d.select("doc_id", "lang"), "doc_id").filter(language_id.held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, "123 !"), (3, "")], "doc_id bigint, text string")
    assert {(r.lang_pred, r.rejected) for r in language_id.identify(odd, model).collect()} == {("und", True)}
    p = np.exp2(-model.models[0].bits(language_id.code_points(["   " + chr(c) for c in range(97, 123)], 4)))
    assert 0 < p.sum() <= 1.0
    # Nothing learned: every text is undetermined, and no table is too empty.
    none = language_id.learned(d.limit(0))
    assert none.languages == [] and {(r.lang_pred, r.score, r.rejected) for r in language_id.identify(odd, none).collect()} == {("und", 0.0, True)}
    assert language_id.learned(d.withColumn("lang", F.lit(None).cast("string"))).languages == [] and language_id.identify(d.limit(0), model).count() == 0
    # Entropies against a plain sum over n-grams, long runs of letters and new n-grams included.
    texts = [r.text for r in d.filter("text is not null").limit(8).collect()] + ["x" * 300 + " ŽŽ, déjà-vu 12a", "ΑΣ ΑΣ", "日本語 テキスト"]
    entropy, length = language_id.Scorer(model).entropies(texts)
    for k, t in enumerate(texts):
        words = [w[i : i + language_id.PIECE] for w in language_id.LETTERS.findall(t.lower()) for i in range(0, len(w), language_id.PIECE)]
        grams = [p[i : i + 4] for w in words for p in ["   " + w + " "] for i in range(len(p) - 3)]
        plain = [m.bits(language_id.code_points(grams, 4)).sum() / len(grams) for m in model.models]
        assert length[k] == len(grams) and np.allclose(entropy[k], plain)


def test_sample_is_the_least_hashed(spark):
    d = spark.range(3000).select(F.lit("aa").alias("__lang"), F.col("id").cast("string").alias("__text"), F.col("id").cast("string").alias("__id"))
    d = d.union(spark.range(7).select(F.lit("bb"), F.col("id").cast("string"), F.col("id").cast("string"))).withColumn("__h", F.xxhash64("__id"))
    got = {(r["__lang"], r["__text"]) for r in common.least_hashed(d, "__lang", ["__id"], 50).collect()}
    rows = sorted((r["__lang"], r["__h"] % 2**64, r["__id"]) for r in d.collect())
    assert got == {(x, i) for x in ("aa", "bb") for _, _, i in [r for r in rows if r[0] == x][:50]}


@pytest.mark.parametrize("swapped", [False, True])
def test_near_dedup_judges_rows_of_one_id_by_their_own_texts(spark, swapped):
    """Two texts under one id: one a near copy of another document, one unlike all else."""
    twins = [(5, LONG + " z"), (5, "of these words no other text has one, nor will it ever")]
    rows = [(3, LONG), *(reversed(twins) if swapped else twins), (9, "of these words no other text has one, nor will it ever"), (None, LONG), (4, None)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, least string").coalesce(1)
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, 116, -1, True), (3, 116, 3, True), (4, 0, 4, True), (5, 8, 5, True), (5, 117, 3, False), (9, 8, 5, False)]
    left = sorted((r.doc_id or -1, r.text or "") for r in minhash.drop_near_duplicates(df).collect())
    assert left == sorted([(3, LONG), (-1, LONG), (4, ""), (5, rows[-3][1])])


def exact_marginals(unary, edges, pots):
    total = np.zeros_like(unary)
    for labels in np.ndindex(*[unary.shape[1]] * len(unary)):
        w = np.exp(sum(unary[i, y] for i, y in enumerate(labels)) + sum(pots[k][labels[i], labels[j]] for i, j, k in edges))
        for i, y in enumerate(labels):
            total[i, y] += w
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("edges,near", [([(0, 1, 0), (1, 2, 0), (1, 3, 1), (3, 4, 0)], 1e-3), ([(0, 1, 0), (1, 2, 0), (2, 3, 0), (0, 3, 1)], 0.05), ([], 1e-12)])
def test_messages_give_exact_marginals_on_trees_and_near_ones_on_loops(edges, near):
    rng = np.random.default_rng(6)
    for _ in range(5):
        unary, pots = rng.normal(size=(5, 3)), np.stack([0.5 * rng.normal(size=(3, 3)), np.eye(3)])
        e = np.array(edges, np.int64).reshape(-1, 3)
        p, restless = pii.marginals(unary, e[:, 0], e[:, 1], e[:, 2], pots, np.zeros(len(e), np.int64))
        assert not len(restless) and np.abs(p - exact_marginals(unary, edges, pots)).max() < near


def test_messages_that_do_not_rest_are_reported(monkeypatch):
    monkeypatch.setattr(pii, "SWEEPS", 1)
    unary = np.array([[0.0, 3.0], [2.0, 0.0], [0.0, 0.0], [0.0, 0.0]])
    _, restless = pii.marginals(unary, np.array([0, 2]), np.array([1, 3]), np.array([0, 0]), np.array([[[2.0, 0.0], [0.0, 1.0]]]), np.array([4, 7]))
    assert restless.tolist() == [4, 7]


def test_field_finds_planted_repeats_and_no_number_that_fails_its_check(spark):
    rng = np.random.default_rng(8)
    rows = []
    for d in range(240):
        a, b, c = rng.integers(200, 999), rng.integers(200, 999), rng.integers(1000, 9999)
        filler = " ".join(f"word{rng.integers(0, 50)}" for _ in range(20))
        bad = f"4{rng.integers(10**14, 10**15 - 1)}"
        bad = bad if not pii.luhn(bad) else bad[:-1] + str((int(bad[-1]) + 1) % 10)
        text = f"Call +1 ({a}) {b}-{c}. {filler} again ({a}) {b}-{c} {filler}" if d % 3 == 0 else f"Ref {bad} {filler} see {bad} and {bad} {filler}" if d % 3 == 1 else f"{filler} mail u{d}@x.example.com or card 4539578763621486 {filler}"
        rows.append((d, text))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(df, pii.fit(df)).collect()}
    repeats = [got[d].spans.count("phone:") for d in range(0, 240, 3)]
    assert sum(n == 2 for n in repeats) >= 0.95 * len(repeats)
    assert all(got[d].spans == "" for d in range(1, 240, 3)) and all(r.rested for r in got.values())
    assert [pii.failed_check(t) for t in ("4539578763621487", "4539578763621486", "1.2.3.256", "1.2.3.4", "12", "a4539578763621487")] == [3, 0, 2, 0, 0, 0]


def kneser_ney_by_hand(grams, order, alphabet):
    """P(last | others) by dictionaries: interpolated, counts of preceding letters below the highest order, one discount an order."""
    tables = []
    counts = dict(grams)
    for k in range(order, 0, -1):
        once, twice = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
        d = min(0.95, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
        tables.insert(0, (counts, d))
        lower = {}
        for g in counts:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        counts = lower

    def p(g):
        if not g:
            return 1 / (alphabet + 1)
        own, d = tables[len(g) - 1]
        after = {x: n for x, n in own.items() if x[:-1] == g[:-1]}
        if not after:
            return p(g[1:])
        total = sum(after.values())
        return max(after.get(g, 0) - d, 0) / total + d * len(after) / total * p(g[1:])

    return p


@pytest.mark.parametrize("text,order", [("abracadabra abrakadabra", 4), ("aaaa bbbb abab baba aabb", 3), ("xyz", 2), ("the then there these their thee", 4)])
def test_language_model_is_kneser_ney(text, order):
    padded = [" " * (order - 1) + w + " " for w in text.split()]
    grams = Counter(p[i : i + order] for p in padded for i in range(len(p) - order + 1))
    model = language_id.CharModel.fit(list(grams), list(grams.values()), order, 26)
    p = kneser_ney_by_hand(grams, order, 26)
    asked = sorted({*grams, *(g[:-1] + c for g in grams for c in "abzq "), *("q" * k + "a" * (order - k) for k in range(order + 1))})
    assert np.allclose(np.exp2(-model.bits(language_id.code_points(asked, order))), [p(g) for g in asked])
