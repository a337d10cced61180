"""The pipeline's stages: columns, what each lets through, and each stage against a brute-force version."""

from array import array
from collections import Counter
from hashlib import sha256

import corpus_pipeline
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from ledgerline.llm import bpe, language_id, mixing

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def norm(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def shingles(t):
    w = norm(t).encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def odd_rows():
    """Nulls, empties, ties, a long text, copies and near copies, ids far apart."""
    base = " ".join(f"palavra{i}" for i in range(60))
    return [(9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, base, "es", "src1", 1), (9004, base.upper(), "es", "src1", 1), (9005, base + " fim", None, "src1", 1), (9006, "the " * 30000, "en", None, 1), (9007, " \n ", "en", "src0", 1), (9008, base, "es", None, 1)]


def test_stages_keep_columns_and_drop_copies(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        now = docs.count()
        assert 0 < now <= before
        before = now
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.count() == before and set(last.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(odd_rows(), KIND))
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    stay = lambda name: sorted(r.doc_id for r in STAGES[name](spark, docs, FOLDER).collect())

    model = language_id.learned(docs.filter(~language_id.held_out()))
    kept = []
    for r in rows:
        words = [w[i : i + language_id.PIECE] for w in language_id.LETTERS.findall((r.text or "").lower()) for i in range(0, len(w), language_id.PIECE)]
        grams = [p[i : i + 4] for w in words for p in ["   " + w + " "] for i in range(len(p) - 3)]
        if grams:
            bits = [m.bits(language_id.code_points(grams, 4)).sum() / len(grams) for m in model.models]
            best = bits.index(min(bits))
            if (bits[best] - model.mean[best]) / (model.spread[best] + len(grams) ** -0.5) <= model.limit[best]:
                kept.append(r.doc_id)
    assert stay("language") == sorted(kept) and len(kept) > 0.9 * len(rows)

    best = {}
    for r in rows:
        best[norm(r.text)] = max(best.get(norm(r.text), -1), r.doc_id)
    assert stay("exact_dedup") == sorted(best.values())

    sets = {r.doc_id: shingles(r.text) for r in rows}
    label = {i: i for i in sets}
    links = [(i, j) for i, a in sets.items() for j, b in sets.items() if i < j and a and b and 100 * len(a & b) >= 75 * len(a | b)]
    for _ in links:
        before = dict(label)
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    assert stay("near_dedup") == sorted(i for i in label if label[i] == i) and links

    chosen = {r.doc_id: r.kept for r in mixing.mixed(docs).collect()}
    assert stay("mixing") == sorted(i for i, x in chosen.items() if x)

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = Counter()
    for r in rows:
        ids = enc.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), sha256(array("I", ids).tobytes()).hexdigest(), sha256((r.text or "").encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in STAGES["tokens"](spark, docs, FOLDER).collect()) == want


def test_stages_on_empty_and_blank_tables(spark):
    for docs in (spark.createDataFrame([], KIND), spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0), (2, "", None, None, 0)], KIND)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert STAGES["tokens"](spark, docs, FOLDER).count() == docs.count()
    assert STAGES["exact_dedup"](spark, docs, FOLDER).agg(F.min("doc_id")).first()[0] == 2
