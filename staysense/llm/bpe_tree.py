"""BPE encoding and decoding (operator 9), with tree concatenation for long unsplit text.

White space never reaches a token of this kind of vocabulary, so a text is encoded word by word
and a task remembers the words it has met.  A stretch that the pre-tokenizer does not split
(a long run of letters or of signs) has no such cuts.  It is halved until the halves are short,
the halves are encoded on their own, and neighbours are joined as a tree: around each join the
text of the last k tokens of the left and the first k of the right is encoded again, k growing
until the new tokens begin with the left side's token and end with the right side's.  A token
sequence is the encoding of its text exactly if every two neighbours are the encoding of
theirs, so agreement at both ends of the window proves the whole.

Stretches of more than ``spread`` code points are dealt out: each half-run is a row, rows are
encoded wherever they land, and each round of the tree joins two rows; other documents never
leave their task.

Defined results: a null text is an empty text, which has no tokens; repeated rows keep their
rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staysense.llm.common import row_key
from staysense.session import cut_lineage

LEAF = 32               # symbols that are merged directly
SPREAD = 8_192          # code points of an unsplit stretch from which on it is dealt out
CACHED_WORDS = 600_000  # words that a task remembers


class Tree:
    """Merges of a vocabulary with word ends, by tree concatenation."""

    def __init__(self, spec: dict, leaf: int = LEAF):
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab, self.leaf = model["vocab"], leaf
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.rank = {p: i for i, p in enumerate(pairs)}

    def direct(self, symbols: str, final: bool) -> list[str]:
        """Tokens of a short run: the best-ranked merge first, the leftmost of equals."""
        parts = list(symbols)
        if final and parts:
            parts[-1] += self.end
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 40))
            pair = parts[best], parts[best + 1]
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def join(self, left: list[str], right: list[str], final: bool) -> list[str]:
        """The encoding of two encoded neighbours; ``final``: the right one ends the run."""
        if not left or not right:
            return left + right
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            last = final and k >= len(right)
            text = "".join(a) + "".join(b)
            new = self.direct(text.removesuffix(self.end) if last else text, last)
            agree_left = k >= len(left) or new[0] == a[0]
            agree_right = k >= len(right) or new[-1] == b[-1]
            if agree_left and agree_right:
                return left[:len(left) - len(a)] + new + right[len(b):]
            k *= 2

    def run(self, symbols: str, final: bool = True) -> list[str]:
        if len(symbols) <= self.leaf:
            return self.direct(symbols, final)
        half = len(symbols) // 2
        return self.join(self.run(symbols[:half], False), self.run(symbols[half:], final), final)


class Words:
    """Ids and tokens of words (stretches without ASCII blanks), remembered up to a bound."""

    def __init__(self, spec: str, leaf: int = LEAF):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        parsed = json.loads(spec)
        parsed["truncation"] = parsed["padding"] = None
        self.library = Tokenizer.from_str(json.dumps(parsed))
        self.tree = Tree(parsed, leaf)
        self.special = [t["content"] for t in parsed["added_tokens"]]
        self.names = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.ids: dict[bytes, bytes] = {}
        self.text: dict[bytes, bytes] = {}

    def pretokens(self, word: str) -> list[str]:
        """The stretches that merges stay within."""
        normal = self.library.normalizer.normalize_str(word) if self.library.normalizer else word
        return [s for s, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def tokens(self, word: str) -> list[str]:
        out = []
        for special, part in self.parts(word):
            out += [part] if special else itertools.chain.from_iterable(map(self.tree.run, self.pretokens(part)))
        return out

    def parts(self, word: str) -> list[tuple[bool, str]]:
        """The word cut at special tokens: (is special, text)."""
        found = [(False, word)]
        for s in self.special:
            found = [y for special, x in found for y in ([(True, x)] if special else
                     [p for i, z in enumerate(x.split(s)) for p in ([(True, s)] if i else []) + [(False, z)]])]
        return [(special, x) for special, x in found if x]

    def id_of(self, token: str) -> int:
        return self.library.token_to_id(token)

    def learn(self, words: set[bytes]) -> None:
        if len(self.ids) + len(words) > CACHED_WORDS:
            self.ids.clear()
            self.text.clear()
        parts, plain = [], set()
        for w in words:
            # the pre-tokenizer parts letters from signs and merging follows lower-casing: a word of
            # ASCII letters with stops after it is made of the plain word and the stops
            core = w.rstrip(b".,!")
            low = core.lower()
            if len(w) <= self.tree.leaf and low.isalpha() and low != w:
                parts.append((w, low, w[len(core):]))
                plain.add(low)
                if len(core) < len(w):
                    plain.add(w[len(core):])
            else:
                plain.add(w)
        short, long = [], []
        for w in plain.difference(self.ids):
            (long if len(w) > self.tree.leaf else short).append(w)
        for w, e in zip(short, self.library.encode_batch_fast([w.decode() for w in short], add_special_tokens=False)):
            self.put(w, e.ids)
        for w in long:
            self.put(w, [self.id_of(t) for t in self.tokens(w.decode())])
        ids, text = self.ids, self.text
        for w, low, tail in parts:
            ids[w] = ids[low] + ids[tail] if tail else ids[low]
            text[w] = text[low] + b" " + text[tail] if tail else text[low]

    def put(self, word: bytes, ids: list[int]) -> None:
        self.ids[word] = struct.pack(f"<{len(ids)}I", *ids)
        self.text[word] = " ".join([self.names[i] for i in ids]).encode()

    def encode(self, texts: list[list[bytes]]) -> list[tuple[bytes, bytes]]:
        """Ids (4 bytes each) and the decoded text of each list of words."""
        met = set(itertools.chain.from_iterable(texts))
        new = met.difference(self.ids)
        if new:
            # learn() forgets all when there are too many
            self.learn(met if len(self.ids) + len(new) > CACHED_WORDS else new)
        ids, text = self.ids.__getitem__, self.text.__getitem__
        return [(b"".join(map(ids, words)), b" ".join(filter(None, map(text, words)))) for words in texts]


def _digests(ids: bytes, text: bytes) -> tuple:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest(), ids, text


_OUT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary, decoded string"


def _batch(rest: list, names: list[str], rows: list[tuple], keep: tuple[str, ...]) -> pa.RecordBatch:
    n, ids_sha, text_sha, ids, texts = zip(*rows) if rows else [()] * 5
    none = [None] * len(rows)
    values = [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()),
              pa.array(ids if "ids" in keep else none, pa.binary()),
              pa.array([x.decode() for x in texts] if "decoded" in keep else none, pa.string())]
    return pa.RecordBatch.from_arrays([*rest, *values], names=[*names, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])


def encode_decode(df: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text",
                  keep: tuple[str, ...] = ("ids", "decoded"),
                  leaf: int = LEAF, spread: int = SPREAD) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of ids and of the decoded text, and those of both that ``keep`` names.

    ``spec``: the tokenizer's JSON.  Ids are little-endian unsigned 32-bit integers.
    """
    kind = dict(df.dtypes)[id_col]
    shared = df.sparkSession.sparkContext.broadcast(spec)       # one vocabulary file
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    unsplit = F.col("text").rlike(r"[^\x20\x09-\x0D]{%d}" % (spread + 1))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value, leaf)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, 64):         # few results at a time
                some = texts.slice(at, 64)
                found = words.encode([t.as_py().split() for t in some])         # bytes: ASCII blanks only
                rows = [_digests(*x) for x in found]
                yield _batch([batch.column(0).slice(at, 64)], ["doc_id"], rows, keep)

    out = docs.where(~unsplit).mapInArrow(whole, f"doc_id {kind}, {_OUT}")
    long = docs.where(unsplit).withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    if not long.isEmpty():
        out = out.unionByName(_spread(long, shared, kind, keep, leaf, spread))
    return out.drop(*({"ids", "decoded"} - set(keep)))


def _spread(long: DataFrame, shared, kind: str, keep: tuple[str, ...], leaf: int, spread: int) -> DataFrame:
    """The same for texts with long unsplit stretches: halves are rows, joins are rounds over rows."""
    rows_of = pa.schema([("key", pa.int64()), ("piece", pa.int32()), ("half", pa.int64()), ("halves", pa.int64()),
                         ("body", pa.string()), ("done", pa.bool_())])
    shape = "key bigint, piece int, half bigint, halves bigint, body string, done boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value, leaf)
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_pylist(list(pieces(words, key.as_py(), text.as_py())), rows_of)

    def pieces(words, key, text):
        piece, plain = 0, []

        def row(body, half=0, halves=1, done=True):
            return {"key": key, "piece": piece, "half": half, "halves": halves, "body": body, "done": done}

        for word in (w.decode() for w in text.encode().split()):
            if len(word) <= spread:
                plain += words.tokens(word)
                continue
            for special, part in words.parts(word):
                for run in [part] if special else words.pretokens(part):
                    if special or len(run) <= spread:
                        plain += [run] if special else words.tree.run(run)
                        continue
                    if plain:
                        yield row(" ".join(plain))
                        piece, plain = piece + 1, []
                    halves = 1 << (-(-len(run) // spread) - 1).bit_length()
                    ends = [len(run) * i // halves for i in range(halves + 1)]
                    for i in range(halves):
                        yield row(run[ends[i]:ends[i + 1]], i, halves, False)
                    piece += 1
        yield row(" ".join(plain))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(json.loads(shared.value), leaf)
        for batch in batches:
            yield pa.RecordBatch.from_pylist(
                [r if r["done"] else r | {"done": True, "body": " ".join(tree.run(r["body"], r["half"] == r["halves"] - 1))}
                 for r in batch.to_pylist()], rows_of)

    def joined(rows: pa.Table) -> pa.Table:
        tree = Tree(json.loads(shared.value), leaf)
        a, *b = sorted(rows.to_pylist(), key=lambda r: r["half"])
        if b:
            final = b[0]["half"] == b[0]["halves"] - 1
            a["body"] = " ".join(tree.join(a["body"].split(" "), b[0]["body"].split(" "), final))
        return pa.Table.from_pylist([a | {"half": a["half"] // 2, "halves": (a["halves"] + 1) // 2}], rows_of)

    def finish(key, rows: pa.Table) -> pa.Table:
        words = Words(shared.value, leaf)
        tokens = [t for r in sorted(rows.to_pylist(), key=lambda r: r["piece"]) for t in r["body"].split(" ") if t]
        ids = b"".join(words.id_of(t).to_bytes(4, "little") for t in tokens)
        batch = _batch([pa.array([key[0].as_py()], pa.int64())], ["key"], [_digests(ids, " ".join(tokens).encode())], keep)
        return pa.Table.from_batches([batch])

    joined.__annotations__ = {"rows": pa.Table, "return": pa.Table}
    finish.__annotations__ = {"key": tuple[pa.Scalar, ...], "rows": pa.Table, "return": pa.Table}
    rows = long.select("key", "text").dropDuplicates(["key"]).mapInArrow(cut, shape)
    rows = cut_lineage(rows.repartition("key", "piece", "half").mapInArrow(leaves, shape))
    most = rows.agg(F.max("halves")).first()[0] or 1
    while most > 1:
        rest = rows.where("halves = 1")
        rows = cut_lineage(rest.unionByName(rows.where("halves > 1").groupBy(
            "key", "piece", F.floor(F.col("half") / 2).alias("pair")).applyInArrow(joined, shape)))
        most = (most + 1) // 2
    found = rows.groupBy("key").applyInArrow(finish, f"key bigint, {_OUT}").withColumnRenamed("key", "k")
    return long.join(found, F.col("key") == F.col("k")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")


def read_spec(name: str = "word_bpe_49k.json") -> str:
    """The JSON of one of the public vocabulary files."""
    import public_tokenizers
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()
