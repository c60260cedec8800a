"""Language-model scores from a log-frequency Bloom filter (operator 5).

Counts of words and word pairs of the training documents are quantised to a level on a
logarithmic scale; an n-gram of level q is put into a Bloom filter as (n-gram, 1) to
(n-gram, q).  To read a count back, (n-gram, 1), (n-gram, 2), ... are probed until one is
missing: a level is never too low, and too high by one only with the filter's error rate.
The probability of a word after another comes from such counts, smoothed with the word's own:
``(c(v, w) + k p(w)) / (c(v) + k)``, ``p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))``.

The filter is made of shards by the n-gram's hash, each with its own number of bits for what
it holds, so it grows with the corpus at a fixed error rate and no task builds more than a
shard.  The shards are broadcast in blocks of at most ``block_mb``; with one block the texts
are scored in one pass, with more each block is probed in a pass of its own and the levels of
a text's positions are put together afterwards.  Nothing is pruned or dropped.

The base score needs exact counts.  The ``HEAD`` most frequent words are broadcast with theirs
(a fixed number of pairs of hash and count); words the filter says are not in the training
documents count 0 for sure; only the others are joined, and none of these can be frequent.
Words are told apart by 64-bit hashes.

Defined results: a null text is an empty text and has the end as its only token; a null id
hashes as empty text; repeated rows keep their rows; without any training document all counts
are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysense.llm.common import row_key
from staysense.session import cut_lineage

HEAD = 65_536
START, END = (xxhash.xxh64_intdigest(b" start "), xxhash.xxh64_intdigest(b" end "))   # no word holds a blank
COUNT_AT_ONCE, SCORE_AT_ONCE = 250_000, 150_000   # tokens that a task handles at a time
COUNTED = 600_000           # n-grams whose counts a task gathers before it passes them on
CACHED_WORDS = 100_000      # hashes that a task remembers


@dataclass(frozen=True)
class BloomModel:
    probes: int = 5                 # hash functions: error rate about 2 ** -probes a level
    base: float = 2.0               # ratio of neighbouring levels
    smoothing: float = 30.0         # k: what a history's own continuations are weighed against
    shard_tokens: int = 200_000     # training tokens per shard
    block_mb: int = 128             # of the filter that is broadcast at a time


class _Hashes(dict):
    """Word -> hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _token_batches(batches: Iterator[pa.RecordBatch],
                   at_once: int = SCORE_AT_ONCE) -> Iterator[tuple[dict, np.ndarray, np.ndarray]]:
    """(other columns, tokens, first token of each text and the end) for some rows at a time.

    A text's tokens are START (a history only), its words, END.
    """
    known = _Hashes()
    for batch in batches:
        names = [n for n in batch.schema.names if n != "text"]
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        at, parts, total = 0, [], 0
        for i in range(batch.num_rows):
            found = texts[i].as_py().lower().split()         # bytes: ASCII blanks, A-Z only
            part = np.empty(len(found) + 2, np.uint64)
            part[0], part[-1] = START, END
            part[1:-1] = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
            parts.append(part)
            total += len(part)
            if total >= at_once or i == batch.num_rows - 1:
                rows = batch.slice(at, i + 1 - at)
                firsts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
                yield {n: rows.column(rows.schema.get_field_index(n)) for n in names}, np.concatenate(parts), firsts
                at, parts, total = i + 1, [], 0


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pairs(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token but the first with the one before it."""
    return _mix(tokens[:-1] * np.uint64(0x9E3779B97F4A7C15) + _mix(tokens[1:]))


def _is_word(n: int, firsts: np.ndarray) -> np.ndarray:
    """Of the tokens but the first: which ones are not a START."""
    out = np.ones(n, bool)
    out[firsts[:-1]] = False
    return out[1:]


def _added(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up per hash."""
    found, at = np.unique(h, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def _packed(n: np.ndarray) -> bytes:
    """Positive counts in as few bytes each as the largest takes."""
    return n.astype(np.min_scalar_type(int(n.max()))).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], grams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Partial counts of the n-grams that ``grams(tokens, firsts)`` gives, gathered up to a bound."""
    h, n = np.empty(0, np.uint64), np.empty(0, np.int64)
    for _, tokens, firsts in _token_batches(batches, COUNT_AT_ONCE):
        new, times = np.unique(grams(tokens, firsts), return_counts=True)
        h, n = _added(np.concatenate((h, new)), np.concatenate((n, times)))
        if len(h) >= COUNTED:
            yield h, n
            h, n = h[:0], n[:0]
    yield h, n


def word_counts(train: DataFrame) -> DataFrame:
    """(h, n): exact counts of words and ends of the column ``text``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, n in _counted(batches, lambda t, f: t[1:][_is_word(len(t), f)]):
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return train.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def build_filter(train: DataFrame, n_tokens: int, model: BloomModel = BloomModel()) -> tuple[DataFrame, int]:
    """(shard, bits, data) of the filter over words, starts and pairs; the number of shards."""
    shards = max(1, -(-n_tokens // model.shard_tokens))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per shard: its hashes and their counts, packed."""
        for h, n in _counted(batches, lambda t, f: np.concatenate([t, _pairs(t)[_is_word(len(t), f)]])):
            shard = _shard(h, shards)
            order = np.argsort(shard, kind="stable")
            names, at = np.unique(shard[order], return_index=True)
            packed = [[a.tobytes() for a in np.split(h[order], at[1:])],
                      [_packed(a) for a in np.split(n[order], at[1:])]] if len(h) else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), *[pa.array(p, pa.binary()) for p in packed]],
                                             names=["shard", "h", "n"])

    counts = train.select("text").mapInArrow(count, "shard int, h binary, n binary")

    def shard(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in rows.column("h").to_pylist()]
        counts = [_unpacked(x, len(p)) for p, x in zip(parts, rows.column("n").to_pylist())]
        h, n = _added(np.concatenate(parts), np.concatenate(counts))
        level = 1 + np.floor(np.log(n) / np.log(model.base) + 1e-9).astype(np.int64)
        entries = int(level.sum())
        bits = -(-int(entries * model.probes / np.log(2)) // 64) * 64 + 64
        data = np.zeros(bits // 8, np.uint8)
        for q in range(1, int(level.max()) + 1):
            places = _places(h[level >= q], q, np.uint64(bits), model.probes)
            np.bitwise_or.at(data, (places >> np.uint64(3)).astype(np.int64).ravel(),
                             (1 << (places & np.uint64(7))).astype(np.uint8).ravel())
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.int64()),
                         "data": pa.array([data.tobytes()], pa.binary())})

    return counts.groupBy("shard").applyInArrow(shard, "shard int, bits bigint, data binary"), shards


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def _places(h: np.ndarray, q: int, bits, probes: int) -> np.ndarray:
    """The bits of (n-gram, q): double hashing; one row per probe."""
    a = _mix(h + np.uint64(q * 0xD6E8FEB86659FD93 % 2 ** 64))
    b = _mix(a) | np.uint64(1)
    return (a + np.arange(probes, dtype=np.uint64)[:, None] * b) % bits


class _Block:
    """Neighbouring shards ``first`` to ``last`` (exclusive) of ``shards``, as a task reads them."""

    def __init__(self, shards: int, first: int, last: int, rows, model: BloomModel):
        self.shards, self.first, self.model = shards, first, model
        self.bits = np.zeros(last - first + 1, np.uint64)       # 0: empty, or (the last one) not in this block
        self.start = np.zeros(last - first + 1, np.uint64)
        data = bytearray()
        for r in rows:
            self.bits[r["shard"] - first], self.start[r["shard"] - first] = r["bits"], 8 * len(data)
            data += r["data"]
        self.data = np.frombuffer(data, np.uint8)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Of each n-gram: the probes (h, 1), (h, 2), ... that succeed before one fails."""
        shard = _shard(h, self.shards) - self.first
        shard[(shard < 0) | (shard >= len(self.bits) - 1)] = len(self.bits) - 1
        bits, start = self.bits[shard], self.start[shard]
        out = np.zeros(len(h), np.uint8)
        left = np.flatnonzero(bits)
        q = 0
        while len(left):
            q += 1
            hit = np.ones(len(left), bool)
            places = _places(h[left], q, bits[left], self.model.probes) + start[left]
            for p in places:
                hit &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
            left = left[hit]
            out[left] = q
            if q == 255:
                break
        return out


def _level_counts(model: BloomModel) -> np.ndarray:
    """The count that each level stands for: the middle of its range."""
    low = np.ceil(model.base ** np.arange(-1, 255, dtype=float) - 1e-9)
    high = np.ceil(model.base ** np.arange(0, 256, dtype=float) - 1e-9) - 1
    mid = (low + np.maximum(high, low)) / 2
    mid[0] = 0.0
    return mid


def _text_scores(word: np.ndarray, pair: np.ndarray, firsts: np.ndarray, n: float, v: float, model: BloomModel):
    """log10 probability per text from the levels of its tokens (START first) and of its pairs."""
    value = _level_counts(model)
    c, cc = value[word], value[pair]
    before = np.maximum(c[:-1], cc)
    p = (cc + model.smoothing * (c[1:] + 0.5) / (n + 0.5 * (v + 1))) / (before + model.smoothing)
    logs = np.where(_is_word(len(word), firsts), np.log10(np.minimum(p, 1.0)), 0.0)
    return np.add.reduceat(np.concatenate(([0.0], logs)), firsts[:-1])


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (5, 1),
          model: BloomModel = BloomModel()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    sc = df.sparkSession.sparkContext
    folds, fold = held_out
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == fold)
    docs = docs.withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    train = docs.where("NOT held_out")
    counts = cut_lineage(word_counts(train))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = int(total), int(distinct)
    head = counts.orderBy(F.desc("n"), "h").limit(HEAD).toPandas().sort_values("h")
    top = sc.broadcast((head["h"].to_numpy(np.int64), head["n"].to_numpy(np.int64)))
    shards_df, shards = build_filter(train, total, model)
    shards_df = cut_lineage(shards_df)
    # n-grams are dealt to shards by hash, so as many shards a block hold about as much
    bits = shards_df.agg(F.coalesce(F.sum("bits"), F.lit(0))).first()[0]
    n_blocks = min(shards, max(1, int(-(-bits // int(model.block_mb * 8e6)))))
    ends = [shards * i // n_blocks for i in range(n_blocks + 1)]
    cells = np.log10(total + 0.5 * (distinct + 1)) if total + distinct else np.log10(0.5)

    def block(i: int):
        rows = shards_df.where((F.col("shard") >= ends[i]) & (F.col("shard") < ends[i + 1])).toLocalIterator()
        found = _Block(shards, ends[i], ends[i + 1], rows, model)
        return sc.broadcast({k: v for k, v in vars(found).items() if k != "model"})     # plain values only

    def base(tokens, firsts, word_levels):
        """Sums over the words whose count is known here, and the others: (text, hash, times)."""
        hs, ns = top.value
        text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts) - 1)
        use = np.ones(len(tokens), bool)
        use[firsts[:-1]] = False
        t, lv = tokens[use].view(np.int64), word_levels[use]
        at = np.minimum(np.searchsorted(hs, t), max(len(hs) - 1, 0))
        in_head = hs[at] == t if len(hs) else np.zeros(len(t), bool)
        c = np.where(in_head, ns[at] if len(hs) else 0, 0)
        sure = in_head | (lv == 0)
        n = len(firsts) - 1
        part = np.bincount(text[sure], np.log10(c[sure] + 0.5), n)
        seen = np.bincount(text[in_head], minlength=n)
        return part, seen, text[~sure], t[~sure], np.diff(firsts) - 1

    def levels(tokens, firsts, where: _Block):
        found, at = np.unique(tokens, return_inverse=True)
        word = where.levels(found)[at]
        pairs = _pairs(tokens)
        found, at = np.unique(pairs, return_inverse=True)
        return word, where.levels(found)[at]

    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("known", pa.int64()), ("part", pa.float64()), ("score", pa.float64()),
                        ("rest", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def one_pass(shared):
        def run(batches):
            here = _Block.__new__(_Block)
            vars(here).update(shared.value, model=model)
            for cols, tokens, firsts in _token_batches(batches):
                word, pair = levels(tokens, firsts, here)
                out = _text_scores(word, pair, firsts, total, distinct, model)
                yield finish(cols, tokens, firsts, word, out)
        return run

    def finish(cols, tokens, firsts, word, out):
        part, seen, text, rest, n = base(tokens, firsts, word)
        order = np.lexsort((rest, text))                # a text's open words together, each once
        text, rest = text[order], rest[order]
        new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (rest[1:] != rest[:-1]))) if len(text) else [])
        times = np.diff(np.append(new, len(text)))
        ends = pa.array(np.searchsorted(text[new], np.arange(len(n) + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays([
            cols["key"], cols["doc_id"], cols["held_out"], pa.array(n), pa.array(seen), pa.array(part), pa.array(out),
            pa.ListArray.from_arrays(ends, pa.array(rest[new])), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))], schema=schema)

    def probe_pass(shared):
        def run(batches):
            here = _Block.__new__(_Block)
            vars(here).update(shared.value, model=model)
            for cols, tokens, firsts in _token_batches(batches):
                word, pair = levels(tokens, firsts, here)
                pair = np.concatenate((pair, np.zeros(1, np.uint8)))
                yield pa.RecordBatch.from_arrays([cols["key"], pa.array(
                    [word[a:b].tobytes() + pair[a:b].tobytes() for a, b in zip(firsts[:-1], firsts[1:])], pa.binary())],
                    names=["key", "levels"])
        return run

    def last_pass(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("levels"))
            merged = pa.array([np.maximum.reduce([np.frombuffer(x, np.uint8) for x in row.as_py()]).tobytes()
                               for row in lists], pa.binary())
            names = [n for n in batch.schema.names if n not in ("levels", "text")]
            plain = pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in names], merged,
                 batch.column(batch.schema.get_field_index("text"))], names=[*names, "merged", "text"])
            for cols, tokens, firsts in _token_batches(iter([plain])):
                both = [np.frombuffer(x.as_py(), np.uint8) for x in cols["merged"]]
                word = np.concatenate([x[:len(x) // 2] for x in both])
                pair = np.concatenate([x[len(x) // 2:] for x in both])[:-1]
                yield finish(cols, tokens, firsts, word, _text_scores(word, pair, firsts, total, distinct, model))

    ready = docs.select("key", F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text")
    kind = "key bigint, doc_id string, held_out boolean, n_tokens bigint, known bigint, part double, score double, rest array<bigint>, times array<int>"
    if n_blocks == 1:
        scored = ready.mapInArrow(one_pass(block(0)), kind)
    else:
        passes = [cut_lineage(ready.select("key", "text").mapInArrow(probe_pass(block(i)), "key bigint, levels binary"))
                  for i in range(n_blocks)]
        probed = passes[0]
        for p in passes[1:]:
            probed = probed.unionByName(p)
        probed = probed.groupBy("key").agg(F.collect_set("levels").alias("levels"))
        scored = ready.join(probed, "key").select("key", "doc_id", "held_out", "levels", "text").mapInArrow(last_pass, kind)
    scored = cut_lineage(scored)
    # what is left of the base score: words that are not frequent and may be known
    twice = scored.groupBy("key").agg(F.count("*").alias("rows"))       # identical rows share a key
    rest = scored.select("key", F.explode_outer(F.arrays_zip("rest", "times")).alias("r")).where("r IS NOT NULL").select(
        "key", F.col("r.rest").alias("h"), F.col("r.times").cast("long").alias("times")).join(counts, "h", "left")
    rest = rest.groupBy(F.col("key").alias("k")).agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_more"))
    rest = rest.join(twice, F.col("k") == F.col("key")).select(
        "k", (F.col("more") / F.col("rows")).alias("more"), (F.col("known_more") / F.col("rows")).cast("long").alias("known_more"))
    return scored.join(rest, F.col("key") == F.col("k"), "left").select(
        F.col("doc_id").cast(dict(df.dtypes)[id_col]).alias("doc_id"), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("known_more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(cells))).alias("base_score"),
        "score")
