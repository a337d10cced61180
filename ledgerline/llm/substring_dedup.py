"""Substring dedup by repeated-phrase automata.

Words covered by a window of 35 words that starts anywhere else too are removed. Steps:

1. *Seeds.* Of the 28 8-word phrases in each window the one of least hash is its seed, so equal
   windows have equal seeds, about 7 in 100 positions are seeds, and only these are shuffled.
2. *Confirm.* Documents with a seed that occurs more than once give, per seed occurrence, the hashes
   of the windows it stands for. Equal lists are counted first (copies collapse there), then single
   windows within their seed. Windows counted twice or more are recurring passages.
3. *Compile.* A seed belongs to the shard of the smallest document key that holds it, so that a document
   meets few shards. Each shard's task reads the passages from the documents that represent them and
   compiles their seed phrases into an Aho-Corasick automaton over word numbers.
4. *Stream.* All stretches of documents that may hold a passage of the shard run through its
   automaton; where a phrase is hit, the windows around it are compared byte by byte with the
   passage. A busy shard's stretches are dealt to several tasks by salt, each with its own automaton.
   Documents without a recurring seed are not streamed. They may hold the eight words of a seed phrase, but only where they
   are no window's least phrase; equal windows have equal seeds, so no window of theirs can equal a passage.

Rows are told apart by a hash of id and text, so ids may repeat or be null; what the hash alone would
confuse is told apart by content. Tasks hold one automaton and one batch; nothing is gathered per
passage or seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, settled
from ledgerline.llm.words import Words, parts

WINDOW, PHRASE = 35, 8
SPAN = WINDOW - PHRASE + 1
#: Seeds that one automaton holds on average; stretches that one task streams on average.
SEEDS_A_SHARD, LOAD_A_TASK = 2_000, 16_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POINT = 0xD6E8FEB86659FD93


class Windows:
    """Seeds and hashes of the windows of several texts.

    ``at`` are the words where windows start, ``text`` the text of each, ``window`` its hash, ``seed`` the
    word where its seed starts; ``phrase[p]`` is the hash of the phrase from word p.
    """

    def __init__(self, words: Words):
        w, n = words.hash, len(words.hash)
        last = words.first[1:] - WINDOW
        counts = np.maximum(last - words.first[:-1] + 1, 0)
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.at = np.arange(counts.sum()) + np.repeat(words.first[:-1] - (np.cumsum(counts) - counts), counts)
        if not len(self.at):
            self.phrase = self.window = np.zeros(0, np.uint64)
            self.seed = np.zeros(0, np.int64)
            return
        h = np.full(n - PHRASE + 1, PHRASE, np.uint64)
        for j in range(PHRASE):
            h = (h ^ w[j : n - PHRASE + 1 + j]) * _MIX
            h ^= h >> np.uint64(29)
        self.phrase = h
        # Order by hash, then place, so that equal windows choose the same phrase.
        least = ((h >> np.uint64(32)) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= SPAN:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < SPAN:
            least = np.minimum(least[: len(least) - (SPAN - size)], least[SPAN - size :])
        self.seed = (least[self.at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.window = self._hashed(w)[self.at]

    @staticmethod
    def _hashed(w: np.ndarray) -> np.ndarray:
        """Polynomial hashes of all windows, by doubling."""
        total, done, power = None, 0, w
        size, rest = 1, WINDOW
        while rest:
            if rest & 1:
                part = power[done : len(w) - WINDOW + 1 + done]
                total = part if total is None else total * np.uint64(pow(_POINT, size, 1 << 64)) + part
                done += size
            rest >>= 1
            power = power[:-size] * np.uint64(pow(_POINT, size, 1 << 64)) + power[size:] if rest else power
            size *= 2
        return total ^ (total >> np.uint64(31))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, last + 1) of each run of windows with one seed, as places in ``at``, and the seed's hash."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        cut = np.flatnonzero(np.diff(self.seed, prepend=-1))
        return cut, np.append(cut[1:], len(self.seed)), self.phrase[self.seed[cut]]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Lists of longs that follow each other in ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def plain_rows(rows: DataFrame, kind: str) -> DataFrame:
    """From (__key, __id, text): __key, __id, n_words, sha (of the text with nothing removed), seeds (distinct
    hashes), again (those that occur more than once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches, 2):
            words = Words(texts)
            found = Windows(words)
            cut, _, seed = found.runs()
            order = np.lexsort((seed, found.text[cut]))
            seed, text = seed[order], found.text[cut][order]
            new = np.ones(len(seed), bool)
            new[1:] = (seed[1:] != seed[:-1]) | (text[1:] != text[:-1])
            firsts = np.flatnonzero(new)
            twice = np.diff(np.append(firsts, len(seed))) > 1
            count = lambda of: np.bincount(of, minlength=len(texts))
            sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
            seeds, again = _lists(seed[firsts], count(text[firsts])), _lists(seed[firsts][twice], count(text[firsts][twice]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(words.first), pa.int64()), pa.array(sha, pa.string()), seeds, again], ["__key", "__id", "n_words", "sha", "seeds", "again"])

    return in_arrow(rows, run, f"__key bigint, __id {kind}, n_words bigint, sha string, seeds array<bigint>, again array<bigint>")


def _sharded(part: pa.RecordBatch, text: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which seeds of texts are among the (seed, shard) in the third column, and their shards."""
    lists = part.column(2)
    known = lists.flatten()
    of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.uint64)
    name = lambda t, s: (s.view(np.uint64) ^ (t.astype(np.uint64) * np.uint64(_POINT))) * _MIX
    keys = name(of, known.field("seed").to_numpy(zero_copy_only=False))
    order = np.argsort(keys)
    keys, shard = keys[order], known.field("shard").to_numpy(zero_copy_only=False)[order]
    names = name(text, seed)
    at = np.minimum(np.searchsorted(keys, names), max(len(keys) - 1, 0))
    there = keys[at] == names if len(keys) else np.zeros(len(names), bool)
    return there, shard[at[there]]


def contexts(candidates: DataFrame) -> DataFrame:
    """From (__key, text, seeds: array of (seed, shard)): a row (seed, shard, __key, windows) per seed occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches, 1):
            found = Windows(Words(texts))
            a, b, seed = found.runs()
            there, shard = _sharded(part, found.text[a], seed)
            keys = np.asarray(part.column(0))[found.text[a[there]]]
            windows = _lists(found.window[np.repeat(there, b - a)], (b - a)[there])
            yield pa.RecordBatch.from_arrays([pa.array(seed[there].view(np.int64), pa.int64()), pa.array(shard, pa.int64()), pa.array(keys, pa.int64()), windows], ["seed", "shard", "__key", "windows"])

    return in_arrow(candidates.select("__key", "text", "seeds"), run, "seed bigint, shard bigint, __key bigint, windows array<bigint>")


def stretches(candidates: DataFrame) -> DataFrame:
    """(shard, __key, start, words): the words of all windows whose seed belongs to the shard, merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches, 1):
            words = Words(texts)
            found = Windows(words)
            a, b, seed = found.runs()
            there, shard = _sharded(part, found.text[a], seed)
            a, b = found.at[a[there]], found.at[b[there] - 1] + WINDOW
            text = found.text[np.searchsorted(found.at, a)]
            order = np.lexsort((a, shard, text))
            a, b, shard, text = a[order], b[order], shard[order], text[order]
            new = np.ones(len(a), bool)
            new[1:] = (shard[1:] != shard[:-1]) | (text[1:] != text[:-1]) | (a[1:] > b[:-1])
            cut = np.flatnonzero(new)
            first, last = a[cut], b[np.append(cut[1:], len(a)) - 1] if len(a) else a
            data = [b" ".join(words.data[x:y].split()) for x, y in zip(words.starts[first].tolist(), words.ends[last - 1].tolist())]
            starts = first - words.first[text[cut]]
            keys = np.asarray(part.column(0))[text[cut]]
            yield pa.RecordBatch.from_arrays([pa.array(shard[cut], pa.int64()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(data, pa.binary())], ["shard", "__key", "start", "words"])

    return in_arrow(candidates.select("__key", "text", "seeds"), run, "shard bigint, __key bigint, start bigint, words binary")


class PhraseAutomaton:
    """Recurring passages of a shard, found through the automaton of their seed phrases.

    Passages stand one after the other in ``text``, their words between ``starts`` and ``ends``; ``keys``
    are the sorted hashes of their windows and ``at`` the word where each begins. Word numbers are places in
    the sorted ``vocabulary`` of the phrases' word hashes, from 1; 0 is any other word.
    """

    def __init__(self):
        self.expected: dict[int, np.ndarray] = {}
        self.texts, self.spans, self.found, self.phrases = [], [], [], []
        self.bytes = self.size = 0
        self.automaton = None

    def expect(self, key: int, windows: np.ndarray) -> None:
        """Recurring windows that the document ``key`` is going to show."""
        self.expected[key] = np.sort(windows)

    def add(self, keys: list[int], stretches: list[bytes]) -> None:
        """Takes from stretches the windows that are expected of their documents."""
        words = Words(stretches)
        found = Windows(words)
        mine = np.zeros(len(found.at), bool)
        edges = np.searchsorted(found.text, np.arange(len(stretches) + 1))
        names = found.window.view(np.int64)
        for k, key in enumerate(keys):
            a, b = edges[k], edges[k + 1]
            mine[a:b] = _places(names[a:b], self.expected[key])[1]
        at = found.at[mine]
        self.texts.append(words.data)
        self.spans.append((words.starts + self.bytes, words.ends + self.bytes))
        self.found.append((names[mine], at + self.size))
        seeds = np.unique(found.seed[mine])
        self.phrases.append(words.hash[seeds[:, None] + np.arange(PHRASE)])
        self.bytes, self.size = self.bytes + len(words.data), self.size + len(words.hash)

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        phrases = np.concatenate([np.zeros((0, PHRASE), np.uint64), *self.phrases])
        self.vocabulary = np.unique(phrases)
        for phrase in set(map(tuple, (np.searchsorted(self.vocabulary, phrases) + 1).tolist())):
            self.automaton.add_word(phrase)
        if len(phrases):
            self.automaton.make_automaton()
            self.text = b"".join(self.texts)
            self.starts, self.ends = (np.concatenate([x[k] for x in self.spans]) for k in (0, 1))
            self.keys, first = np.unique(np.concatenate([x[0] for x in self.found]), return_index=True)
            self.at = np.concatenate([x[1] for x in self.found])[first]
        self.expected, self.texts, self.spans, self.found, self.phrases = {}, [], [], [], []

    def occurrences(self, stretches: list[bytes]) -> list[tuple[int, int, int]]:
        """(stretch, first word, last word + 1) covered by windows of the passages, merged, in order.

        The stretches run through the automaton as one sequence; windows around its hits are looked up,
        and runs of windows that continue a passage are compared with it byte by byte.
        """
        if not len(self.automaton):
            return []
        words = Words(stretches)
        number, known = _places(words.hash, self.vocabulary)
        hits = [end for end, _ in self.automaton.iter(tuple(np.where(known, number + 1, 0).tolist()))]
        if not hits:
            return []
        found = Windows(words)
        p = np.array(hits) - (PHRASE - 1)
        near = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(near, np.maximum(p - SPAN + 1, 0), 1)
        np.add.at(near, p + 1, -1)
        close = np.flatnonzero(np.cumsum(near)[found.at] > 0)
        place, there = _places(found.window[close].view(np.int64), self.keys)
        s, of = found.at[close[there]], found.text[close[there]]
        if not len(s):
            return []
        at = self.at[place[there]]
        cut = np.flatnonzero((np.diff(s) != 1) | (np.diff(at) != 1) | (np.diff(of) != 0)) + 1
        out: list[list[int]] = []
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(s)]):
            a, n, o, k = int(s[i]), j - i + WINDOW - 1, int(at[i]), int(of[i])
            spans = [(a, a + n)] if self._same(words, a, o, n) else [(a + d, a + d + WINDOW) for d in range(j - i) if self._same(words, a + d, o + d, WINDOW)]
            for x, y in spans:
                if out and out[-1][0] == k and x <= out[-1][2]:
                    out[-1][2] = max(out[-1][2], y)
                else:
                    out.append([k, x, y])
        return [(k, int(x - words.first[k]), int(y - words.first[k])) for k, x, y in out]

    def _same(self, words: Words, a: int, o: int, n: int) -> bool:
        """Whether n words from a of stretches are those from o of the passages; both have single spaces."""
        return words.data[words.starts[a] : words.ends[a + n - 1]] == self.text[self.starts[o] : self.ends[o + n - 1]]


def _places(names: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted ``keys``, whether it is there) of each name."""
    if not len(keys):
        return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    at = np.minimum(np.searchsorted(keys, names), len(keys) - 1)
    return at, keys[at] == names


def _mark(data: bytes, words: int) -> int:
    """What a range of words is checked by when it is cut out."""
    return xxhash.xxh3_64_intdigest(data, words) - (1 << 63)


def located(dealt: DataFrame) -> DataFrame:
    """(__key, a, b, mark) of every occurrence. ``dealt``: shard, salt, kind, __key, start, words, windows, each
    (shard, salt) in one partition: hashes of recurring windows by the document that represents them
    (kind 0), those documents' stretches (1), then the stretches to search (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, machine = None, None
        for part, texts in parts(batches, 5):
            shard, salt, kind, key, start = (np.asarray(part.column(c)) for c in ("shard", "salt", "kind", "__key", "start"))
            cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1
            out: list[tuple[int, int, int, int]] = []
            for i, j in zip([0, *cut.tolist()], [*cut.tolist(), part.num_rows]):
                if of != (shard[i], salt[i]):
                    of, machine = (shard[i], salt[i]), PhraseAutomaton()
                if kind[i] == 0:
                    for k in range(i, j):
                        machine.expect(int(key[k]), np.asarray(part.column(6)[k].values))
                elif kind[i] == 1:
                    machine.add(key[i:j].tolist(), texts[i:j])
                else:
                    if machine.automaton is None:
                        machine.compile()
                    for k, a, b in machine.occurrences(texts[i:j]):
                        mark = _mark(b" ".join(texts[i + k].split(b" ")[a:b]), b - a)
                        out.append((int(key[i + k]), int(start[i + k]) + a, int(start[i + k]) + b, mark))
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(4)], ["__key", "a", "b", "mark"])

    return in_arrow(dealt, run, "__key bigint, a bigint, b bigint, mark bigint")


def removed(candidates: DataFrame, ranges: DataFrame) -> DataFrame:
    """__key, sha (of the whole), n_removed, kept_sha256, kept for the candidates, given their ranges of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches, 1):
            whole, gone, sha, kept = [], [], [], []
            for text, ranges in zip(texts, part.column(2).to_pylist()):
                words = text.split()
                left, at = [], 0
                for a, b in sorted((x["a"], x["b"]) for x in ranges or () if _mark(b" ".join(words[x["a"] : x["b"]]), x["b"] - x["a"]) == x["mark"]):
                    left += words[at : max(at, a)]
                    at = max(at, b)
                left += words[at:]
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
                whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(whole, pa.string()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), pa.array([x.decode() for x in kept], pa.string())], ["__key", "sha", "n_removed", "kept_sha256", "kept"])

    per_document = ranges.groupBy("__key").agg(F.collect_list(F.struct("a", "b", "mark")).alias("ranges"))
    rows = candidates.select("__key", "text").join(per_document, "__key").select("__key", "text", "ranges")
    return in_arrow(rows, run, "__key bigint, sha string, n_removed bigint, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, kept.

    kept is the text left, words joined by one space; it is null where nothing was removed (the text
    itself is at hand there). Null and empty texts have no words. A window that occurs twice in one document
    counts, as do repeated rows. Ids may be of any type, repeat or be null. Other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.xxhash64(F.col(id_col).cast("string"), text).alias("__key"), F.col(id_col).alias("__id"), text.alias("text"))
    plain = settled(plain_rows(rows, docs.schema[id_col].dataType.simpleString()), "repeats-plain")
    # A seed twice in one document counts as two.
    seeds = plain.select("__key", F.explode("seeds").alias("seed"), "again").select("__key", "seed", F.when(F.array_contains("again", F.col("seed")), 2).otherwise(1).alias("times"))
    recurring = settled(seeds.groupBy("seed").agg(F.sum("times").alias("times"), F.min("__key").alias("first")).filter("times > 1").select("seed", "first"), "repeats-seeds")
    shards = max(1, -(-recurring.count() // SEEDS_A_SHARD))
    sharded = recurring.select("seed", F.pmod(F.xxhash64("first"), F.lit(shards)).alias("shard"))
    lists = plain.select("__key", F.explode("seeds").alias("seed")).join(sharded, "seed").groupBy("__key").agg(F.collect_list(F.struct("seed", "shard")).alias("seeds"))
    candidates = settled(rows.select("__key", "text").join(lists, "__key").select("__key", "text", "seeds"), "repeats-candidates")
    # Copies give equal lists of windows and collapse before windows are counted one by one.
    lists = contexts(candidates).groupBy("seed", "windows").agg(F.count("*").alias("n"), F.min("__key").alias("of"), F.min("shard").alias("shard"))
    single = lists.select("seed", "shard", "n", "of", F.explode("windows").alias("window"))
    passages = single.groupBy("seed", "window").agg(F.sum("n").alias("n"), F.min("of").alias("of"), F.min("shard").alias("shard")).filter("n > 1")
    providers = settled(passages.groupBy("shard", "of").agg(F.collect_list("window").alias("windows")), "repeats-passages")
    pieces = settled(stretches(candidates), "repeats-stretches")
    busy = pieces.groupBy("shard").agg(F.ceil(F.count("*") / LOAD_A_TASK).cast("int").alias("salts"))
    live = busy.join(providers.select("shard").distinct(), "shard")
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    hashes = providers.join(live, "shard").select("shard", salts, F.lit(0).alias("kind"), F.col("of").alias("__key"), F.lit(0).cast("bigint").alias("start"), F.lit(None).cast("binary").alias("words"), "windows")
    told = pieces.join(providers.select("shard", F.col("of").alias("__key")), ["shard", "__key"], "left_semi").join(live, "shard")
    none = F.lit(None).cast("array<bigint>").alias("windows")
    patterns = told.select("shard", salts, F.lit(1).alias("kind"), "__key", "start", "words", none)
    texts = pieces.join(live, "shard").select("shard", F.pmod(F.xxhash64("__key"), F.col("salts")).cast("int").alias("salt"), F.lit(2).alias("kind"), "__key", "start", "words", none)
    dealt = hashes.unionByName(patterns).unionByName(texts).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    cut = settled(removed(candidates, located(dealt)), "repeats-removed")
    done = cut.filter("n_removed > 0").dropDuplicates(["__key", "sha"])
    out = plain.select("__key", "__id", "n_words", "sha").join(done, ["__key", "sha"], "left")
    return out.select(F.col("__id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")
