"""Language identification by a bidirectional gated recurrent network over bytes (operator 7).

The network reads a window of bytes in both directions; the two states at a position give a
distribution over the languages there, so every position is labelled, and a document's
probabilities are the mean over its positions.  It is trained in numpy by backpropagation
through time on windows of a bounded number of labelled documents (``per_language`` windows of
``train_bytes`` from different documents per language, the least by hash: a documented sample
for fitting, reruns agree); counts, texts and predictions cover every document and every byte.

Prediction cuts a whole text into windows of ``step`` bytes with ``margin`` bytes of context on
both sides; only the inner positions are pooled, so each byte of the text counts once.  Windows
of many documents run through the network together, in blocks of bounded size.

Building the query runs the fit, so its first jobs run before the result is asked for.

Only bytes of the text are inputs.  Defined results: of languages of equal probability the first by name; ``und`` with score 0 for a null text, one
without a letter, or when there is nothing to learn from; repeated rows keep their rows; a null
id hashes as empty text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staysense.functions.joins import bounded_broadcast
from staysense.session import cut_lineage


@dataclass(frozen=True)
class GruPlan:
    hidden: int = 8             # units per direction
    per_language: int = 512     # training windows per language: the bound of the fitting sample
    train_bytes: int = 80
    epochs: int = 20
    batch: int = 64
    rate: float = 0.02
    step: int = 112             # bytes of a window that are pooled
    margin: int = 8             # bytes of context before and after them
    block: int = 8_192          # windows that run together
    seed: int = 7


SPARE = 8                       # windows that are ranked per language, times those that are taken
PAD = 256                       # the byte number of what lies outside a text


class ByteGru:
    """The network: per direction an input table (a row per byte) and a recurrent matrix for the
    update gate, the reset gate and the candidate; one output layer for both states."""

    def __init__(self, classes: int, plan: GruPlan):
        h, rng = plan.hidden, np.random.default_rng(plan.seed)
        self.hidden, self.classes = h, classes
        self.w = {}
        for d in ("f", "b"):
            self.w[f"x{d}"] = rng.normal(0, 0.3, (257, 3 * h)).astype(np.float32)
            self.w[f"g{d}"] = rng.normal(0, 1 / np.sqrt(h), (h, 2 * h)).astype(np.float32)     # gates
            self.w[f"c{d}"] = rng.normal(0, 1 / np.sqrt(h), (h, h)).astype(np.float32)         # candidate
        self.w["o"] = rng.normal(0, 0.3, (2 * h, classes)).astype(np.float32)
        self.w["ob"] = np.zeros(classes, np.float32)

    def _scan(self, x: np.ndarray, d: str, keep: bool):
        """States after each position of ``x`` (time, windows); with ``keep`` also what BPTT needs."""
        h, table, gates, cand = self.hidden, self.w[f"x{d}"], self.w[f"g{d}"], self.w[f"c{d}"]
        steps, n = x.shape
        s, out, kept = np.zeros((n, h), np.float32), np.empty((steps, n, h), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = table[x[t]]
            zr = a[:, :2 * h] + s @ gates
            zr *= 0.5
            np.tanh(zr, out=zr)                     # sigmoid(v) = (1 + tanh(v / 2)) / 2
            zr += 1.0
            zr *= 0.5
            z, r = zr[:, :h], zr[:, h:]
            c = r * s
            c = c @ cand
            c += a[:, 2 * h:]
            np.tanh(c, out=c)
            if keep:
                kept.append((t, s, z, r, c))
            new = c - s
            new *= z
            new += s
            out[t] = s = new
        return out, kept

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(time, windows, classes) for byte numbers ``x`` (time, windows)."""
        h = self.hidden
        p = self._scan(x, "f", False)[0] @ self.w["o"][:h]
        p += self._scan(x, "b", False)[0] @ self.w["o"][h:]
        p += self.w["ob"]
        p -= p.max(axis=2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=2, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, label: np.ndarray, weight: np.ndarray):
        """Mean cross entropy of all weighted positions and its gradient, through time."""
        h = self.hidden
        sf, kf = self._scan(x, "f", True)
        sb, kb = self._scan(x, "b", True)
        both = np.concatenate((sf, sb), axis=2)
        p = both @ self.w["o"] + self.w["ob"]
        p -= p.max(axis=2, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=2, keepdims=True)
        hot = np.arange(self.classes)[None, None, :] == label[None, :, None]
        total = max(float(weight.sum()), 1.0)
        loss = -float((np.log(p[:, np.arange(len(label)), label] + 1e-9) * weight).sum()) / total
        e = (p - hot) * (weight / total)[:, :, None]
        g = {"o": np.einsum("tnh,tnk->hk", both, e), "ob": e.sum(axis=(0, 1))}
        back = e @ self.w["o"].T
        for d, kept, part in (("f", kf, back[:, :, :h]), ("b", kb, back[:, :, h:])):
            gx, gg, gc = (np.zeros_like(self.w[f"{k}{d}"]) for k in "xgc")
            ds = np.zeros_like(part[0])
            for t, s, z, r, c in reversed(kept):
                ds = ds + part[t]
                dc = ds * z * (1 - c * c)
                dz = ds * (c - s) * z * (1 - z)
                drs = dc @ self.w[f"c{d}"].T
                dr = drs * s * r * (1 - r)
                dzr = np.concatenate((dz, dr), axis=1)
                gg += s.T @ dzr
                gc += (r * s).T @ dc
                np.add.at(gx, x[t], np.concatenate((dzr, dc), axis=1))
                ds = ds * (1 - z) + drs * r + dzr @ self.w[f"g{d}"].T
            g |= {f"x{d}": gx, f"g{d}": gg, f"c{d}": gc}
        return loss, g

    def fit(self, x: np.ndarray, label: np.ndarray, plan: GruPlan) -> list[float]:
        """Adam over shuffled batches; returns the loss of each epoch."""
        rng = np.random.default_rng(plan.seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(w) for k, w in self.w.items()}
        weight, losses, n = (x != PAD).astype(np.float32), [], 0
        for epoch in range(plan.epochs):
            order, total = rng.permutation(x.shape[1]), 0.0
            rate = plan.rate * (1 - 0.9 * epoch / plan.epochs)
            for at in range(0, len(order), plan.batch):
                pick = order[at:at + plan.batch]
                loss, g = self.gradients(x[:, pick], label[pick], weight[:, pick])
                total, n = total + loss * len(pick), n + 1
                norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
                for k, q in g.items():
                    q = q / max(1.0, norm)
                    m[k] += 0.1 * (q - m[k])
                    v[k] += 0.001 * (q * q - v[k])
                    self.w[k] -= (rate * (m[k] / (1 - 0.9 ** n)) / (np.sqrt(v[k] / (1 - 0.999 ** n)) + 1e-8)).astype(np.float32)
            losses.append(total / max(len(order), 1))
        return losses


def training_windows(docs: DataFrame, plan: GruPlan, counts: DataFrame | None = None) -> DataFrame:
    """(lang, piece): a window of text from each of the sampled documents, at a place that its hash names.

    The sample is the ``per_language`` windows of least hash.  With ``counts`` (lang, n) only hashes low enough to expect
    ``SPARE`` times as many are ranked, so that a language's ranking is bounded however many rows and tasks it has.
    """
    at = F.pmod(F.xxhash64(F.lit("place"), "text"), F.greatest(F.length("text") - plan.train_bytes, F.lit(1))).cast("int") + 1
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("place", F.xxhash64("doc_id", "text"))
    if counts is not None:
        low = (F.col("place") / float(1 << 64) + 0.5) < F.lit(float(SPARE * plan.per_language)) / F.col("n")
        docs = docs.select("lang", "place", "text").join(bounded_broadcast(counts), "lang").where(low)
    pieces = docs.select("lang", "place", F.substring("text", at, F.lit(plan.train_bytes)).alias("piece"))
    pieces = pieces.where(F.col("piece").rlike(r"\p{L}"))
    rank = Window.partitionBy("lang").orderBy("place", "piece")
    return pieces.withColumn("i", F.row_number().over(rank)).where(F.col("i") <= plan.per_language).select("lang", "piece")


def training_sample(docs: DataFrame, plan: GruPlan):
    """The sample as a pandas frame: at most ``per_language`` short windows a language.

    If low hashes give a language too few windows (most of its texts have no letters), all its hashes are ranked.
    """
    counts = cut_lineage(docs.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")))
    sample = training_windows(docs, plan, counts).toPandas()
    many = {r.lang for r in counts.where(F.col("n") > SPARE * plan.per_language).collect()}      # a name a language
    got = sample["lang"].value_counts()
    if any(got.get(x, 0) < plan.per_language for x in many):
        sample = training_windows(docs, plan).toPandas()
    return sample.sort_values(["lang", "piece"])


def _bytes(text: str, length: int) -> np.ndarray:
    data = np.frombuffer(text.encode()[:length], np.uint8)
    return np.concatenate((data.astype(np.int16), np.full(length - len(data), PAD, np.int16)))


def fit(docs: DataFrame, plan: GruPlan = GruPlan()) -> tuple[ByteGru | None, list[str]]:
    """The network and its languages, from ``docs`` (doc_id, text, lang); None without labelled text."""
    sample = training_sample(docs, plan)
    languages = sorted(sample["lang"].unique())
    if not languages:
        return None, []
    x = np.stack([_bytes(t, plan.train_bytes) for t in sample["piece"]], axis=1)
    # half of the windows begin, and half end, outside a text, as those of short texts do
    rng = np.random.default_rng(plan.seed)
    x[:plan.margin, rng.random(x.shape[1]) < 0.5] = PAD
    x[-plan.margin:, rng.random(x.shape[1]) < 0.5] = PAD
    net = ByteGru(len(languages), plan)
    net.fit(x, np.searchsorted(languages, sample["lang"]), plan)
    return net, languages


def _document_sums(net: ByteGru, texts: list[bytes], plan: GruPlan) -> np.ndarray:
    """Per text: the sum over its positions of the probabilities."""
    out = np.zeros((len(texts), net.classes))
    width = plan.step + 2 * plan.margin
    blocks: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    waiting = 0

    def run():
        x, who = np.concatenate(blocks), np.concatenate(owners)
        for at in range(0, len(x), plan.block):
            part = np.ascontiguousarray(x[at:at + plan.block].T)
            inner = slice(plan.margin, plan.margin + plan.step)
            real = (part[inner] != PAD)[:, :, None]
            sums = (net.probabilities(part)[inner] * real).sum(axis=0)
            np.add.at(out, who[at:at + plan.block], sums)

    for i, t in enumerate(texts):
        n = max(1, -(-len(t) // plan.step))
        padded = np.full(n * plan.step + 2 * plan.margin, PAD, np.int16)
        padded[plan.margin:plan.margin + len(t)] = np.frombuffer(t, np.uint8)
        views = np.lib.stride_tricks.sliding_window_view(padded, width)[::plan.step]
        for at in range(0, n, plan.block):
            blocks.append(views[at:at + plan.block])
            owners.append(np.full(len(blocks[-1]), i))
            waiting += len(blocks[-1])
            if waiting >= plan.block:
                run()
                blocks, owners, waiting = [], [], 0
    if blocks:
        run()
    return out


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_out: tuple[int, int] = (4, 2), plan: GruPlan = GruPlan()) -> DataFrame:
    """doc_id, held_out, lang_pred, score (mean probability of the prediction) for every row."""
    folds, fold = held_out
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                     held.alias("held_out"))
    net, languages = fit(docs.where("NOT held_out"), plan)
    kind = dict(df.dtypes)[id_col]

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            pred, score = np.full(len(rows), "und", object), np.zeros(len(rows))
            if net is not None:
                use = np.flatnonzero(rows["letters"].to_numpy(bool))
                texts = [rows["text"].iat[i].encode() for i in use]
                mean = _document_sums(net, texts, plan) / np.array([max(len(t), 1) for t in texts])[:, None]
                best = mean.argmax(axis=1)
                pred[use], score[use] = np.array(languages, object)[best], mean.max(axis=1).clip(0, 1)
            yield rows[["doc_id", "held_out"]].assign(lang_pred=pred, score=score)

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    # doc_id as text: pandas has no integers with nulls
    ready = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", F.coalesce("text", F.lit("")).alias("text"),
                        letters.alias("letters"))
    out = ready.mapInPandas(predict, "doc_id string, held_out boolean, lang_pred string, score double")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
