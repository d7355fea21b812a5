"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read the UTF-8 bytes of a window forwards and
backwards; their states give language probabilities at every byte, and a
document's probabilities are the means over all its bytes. The network is
trained by backpropagation through time, in numpy, on a bounded sample: whole
texts of at most ``per_language`` documents of each language, chosen by a hash
of the text alone; equal texts count once. ``accepted`` learns from every
labelled document that isn't held out: where a language has more of them, the
sample only gives the weights to start from. All documents are then dealt to
``ROUNDS`` parts by hash, and each round moves the weights along the gradient
over all windows of its part, summed by Spark; the texts of one hash in
``CHECKED`` are left out of both, and all of them calibrate the least
probability. The weights (some tens of kilobytes) travel with the
tasks; every byte of every text is labelled, in windows of ``WINDOW`` bytes
that are read independently of each other, so memory doesn't grow with a text.

Defined results: a null text, or one without a letter, is ``und`` with score
0; rows without a language are not learned from; without any training rows
every document is ``und``; ids may be null and rows repeated; an empty table
gives an empty result; other columns never enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from daybook.llm.common import reused, slices, trimmed
from daybook.llm.quality import held_out

WINDOW, HIDDEN = 128, 8
PER_LANGUAGE = 1500  # whole texts that the driver learns from
ROUNDS = 6  # parts of the corpus, a step of the weights each, where the driver doesn't learn from all
AT_ONCE = 512  # windows of one language that a task takes the gradient of
CHECKED = 10  # a text in so many is left out of the training, to calibrate the least probability
ENOUGH = 100  # texts to calibrate on; with fewer, only the chance of the number of languages is asked for
MARGIN = 0.9  # of the lowest probability that a calibration text has
STEPS, BATCH, LEARNING_RATE = 350, 96, 0.02
PAD = 256
UNKNOWN = "und"


class ByteNetwork:
    """``w``: gate inputs per byte; ``u``: state to gates; gates in the order update, reset, candidate.

    Update and reset are hard logistic functions clip(a / 4 + 1 / 2, 0, 1), the
    candidate is a / (1 + |a|): both cost a few vector instructions. Arrays are
    laid out (time, feature, window), so that every step works on whole rows.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.h, self.least = languages, hidden, 0.0
        shape = {"w": (257, 3 * hidden), "u": (hidden, 3 * hidden)}
        self.p = {f"{k}{side}": rng.normal(0, 0.25 if k == "u" else 0.3, s).astype(np.float32) for side in "fb" for k, s in shape.items()}
        for side in "fb":
            self.p[f"w{side}"][:, :hidden] += 1.0  # at first keep the state rather than replace it
            self.p[f"w{side}"][PAD] = 0
            self.p[f"w{side}"][PAD, :hidden] = 1000.0  # padding leaves the state as it is
        self.p["v"] = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.p["c"] = np.zeros(len(languages), np.float32)

    def run(self, x: np.ndarray, side: str, keep: bool = False):
        """States before and after each byte of ``x`` (time, windows), in the order of reading; with ``keep`` also the gates."""
        n, scale = self.h, np.ones(3 * self.h, np.float32)
        scale[: 2 * n] = 0.25
        w, u = self.p[f"w{side}"] * scale, np.ascontiguousarray((self.p[f"u{side}"] * scale).T)
        w[:, : 2 * n] += 0.5
        w = np.ascontiguousarray(w.T)
        t, b = x.shape
        states = np.zeros((t + 1, n, b), np.float32)
        gates = np.zeros((t, 4 * n, b), np.float32) if keep else None
        a, s, one = np.empty((3 * n, b), np.float32), np.empty((3 * n, b), np.float32), np.empty((n, b), np.float32)
        zr, z, r, cand, hu = a[: 2 * n], a[:n], a[n : 2 * n], a[2 * n :], s[2 * n :]
        for i in range(t):
            h, new = states[i], states[i + 1]
            np.take(w, x[i], axis=1, out=a, mode="clip")
            np.matmul(u, h, out=s)
            zr += s[: 2 * n]
            np.maximum(zr, 0, out=zr)
            np.minimum(zr, 1, out=zr)
            if keep:
                gates[i, 3 * n :] = hu
            hu *= r
            cand += hu
            np.abs(cand, out=one)
            one += 1
            cand /= one
            np.subtract(h, cand, out=new)
            new *= z
            new += cand
            if keep:
                gates[i, : 3 * n] = a
        return states, gates

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (time, languages, windows) of every byte."""
        f, _ = self.run(x, "f")
        b, _ = self.run(x[::-1], "b")
        return self.softmax(f[1:], b[1:][::-1])

    def softmax(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        v = np.ascontiguousarray(self.p["v"].T)
        y = np.matmul(v[:, : self.h], f)
        y += np.matmul(v[:, self.h :], b)
        y += self.p["c"][:, None]
        y -= y.max(axis=1, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=1, keepdims=True)
        return y

    def gradients(self, x: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross-entropy over all real bytes."""
        n, xb = self.h, x[::-1]
        (f, gf), (b, gb) = self.run(x, "f", True), self.run(xb, "b", True)
        q = self.softmax(f[1:], b[1:][::-1])
        real = (x != PAD)[:, None, :]
        q[:, target, np.arange(x.shape[1])] -= 1
        q *= real / max(1, real.sum())
        both = np.concatenate([f[1:], b[1:][::-1]], axis=1)
        some = max(1, WINDOW * BATCH // x.shape[1])  # steps at once, so that they stay in the cache
        parts = (np.einsum("tkb,tlb->kl", both[k : k + some], q[k : k + some], optimize=True) for k in range(0, len(x), some))
        out = {"v": sum(parts), "c": q.sum((0, 2))}
        back = np.matmul(self.p["v"], q)
        for side, xs, states, gates, d_out in (("f", x, f, gf, back[:, :n]), ("b", xb, b, gb, back[:, n:][::-1])):
            u, du = self.p[f"u{side}"], np.zeros_like(self.p[f"u{side}"])
            dw = np.zeros((3 * n, 257), u.dtype.type)  # the type: np.add.at is some 15 times slower with a dtype that was unpickled, as in tasks
            z, r, c, hu = (gates[:, k * n : (k + 1) * n] for k in range(4))
            dh, da = np.zeros(states.shape[1:], np.float32), np.empty((3 * n, len(xs), x.shape[1]), np.float32)
            ds, t, both_in = np.empty((3 * n, x.shape[1]), np.float32), np.empty_like(dh), np.empty((2 * n, x.shape[1]), bool)
            above, below = np.empty_like(both_in), gates[:, : 2 * n]
            dz, dr, dzr, dc = ds[:n], ds[n : 2 * n], ds[: 2 * n], ds[2 * n :]
            for i in range(len(xs) - 1, -1, -1):  # each step's arrays stay in the cache
                dh += d_out[i]
                np.abs(c[i], out=t)
                np.subtract(1, t, out=t)
                t *= t
                np.subtract(1, z[i], out=dc)
                dc *= dh
                dc *= t
                np.subtract(states[i], c[i], out=dz)
                dz *= dh
                np.multiply(dc, hu[i], out=dr)
                np.greater(below[i], 0, out=both_in)
                np.less(below[i], 1, out=above)
                both_in &= above
                dzr *= 0.25
                dzr *= both_in
                da[:, i] = ds
                dc *= r[i]
                du += states[i] @ ds.T
                dh *= z[i]
                dh += u @ ds
            at = xs.ravel()
            for k in range(3 * n):
                np.add.at(dw[k], at, da[k].ravel())
            dw = np.ascontiguousarray(dw.T)
            dw[PAD] = 0
            out[f"w{side}"], out[f"u{side}"] = dw, du
        return out

    def train(self, windows: list[bytes], target: np.ndarray, steps: int = STEPS, batch: int = BATCH, seed: int = 11) -> None:
        """Adam over batches with as many windows of each language."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        groups = [np.flatnonzero(target == k) for k in range(len(self.languages))]
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
            grads = self.gradients(padded([windows[i] for i in pick]), target[pick])
            rate = LEARNING_RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                np.clip(g, -1, 1, out=g)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        self.spread = {k: np.sqrt(a / (1 - 0.99**steps)) for k, a in v.items()}  # of the last gradients

    def step(self, grads: dict[str, np.ndarray]) -> None:
        """Against a gradient over many rows, in units of what the gradients of batches spread, by a unit at most."""
        for k, g in grads.items():
            self.p[k] -= (LEARNING_RATE * np.clip(g / (self.spread[k] + 1e-8), -1, 1)).astype(np.float32)

    def pooled(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, batch: int = 2048) -> np.ndarray:
        """Mean probabilities of each text: ``data`` holds all bytes, a text has ``lengths`` of them from ``starts``."""
        sums = np.zeros((len(starts), len(self.languages)))
        count = -(-lengths // WINDOW)
        owner = np.repeat(np.arange(len(starts)), count)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at = starts[owner] + place * WINDOW
        size = np.minimum(WINDOW, lengths[owner] - place * WINDOW)
        order = np.argsort(size, kind="stable")  # windows of like length together: little padding
        for k in range(0, len(order), batch):
            o = order[k : k + batch]
            steps = np.arange(int(size[o].max()))[:, None]
            real = steps < size[o]
            x = np.where(real, data[np.minimum(at[o] + steps, len(data) - 1)].astype(np.int64), PAD)  # PAD doesn't fit a byte
            q = self.labels(x)
            q *= real[:, None, :]
            np.add.at(sums, owner[o], q.sum(0, dtype=np.float64).T)
        return sums / np.maximum(lengths, 1)[:, None]


def padded(windows: list[bytes]) -> np.ndarray:
    x = np.full((max(1, max(map(len, windows))), len(windows)), PAD, np.int64)
    for k, w in enumerate(windows):
        x[: len(w), k] = np.frombuffer(w, np.uint8)
    return x


def labelled(docs: DataFrame) -> DataFrame:
    """``lang, u, text`` of every document to learn from; ``u``: a hash of the text alone."""
    rows = docs.where(~held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    return rows.select("lang", F.xxhash64("text", F.lit("langid")).alias("u"), "text")


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, bytes]]:
    """At most ``per_language`` whole texts of each language, never of held-out documents, in a fixed order."""
    named = labelled(docs)
    return chosen(named, {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}, per_language)


def chosen(named: DataFrame, counts: dict[str, int], per_language: int) -> list[tuple[str, bytes]]:
    """``sample`` of ``labelled`` rows, ``counts`` of them in each language."""
    if not counts:
        return []
    # twice the wanted share by hash, then exactly the smallest hashes, each text once
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * per_language / n))))
    near = F.pmod("u", F.lit(1 << 30)) / F.lit(float(1 << 30)) < share[F.col("lang")]
    # by hash first: the texts of one hash are few unless equal, and the window keeps no more than are asked for
    once = named.where(near).groupBy("lang", "u").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("u", F.lit(1 << 30)), "u")
    got = once.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_language).select("lang", "text").collect()
    return sorted((r["lang"], r["text"].encode()) for r in got)


def windows(text: bytes) -> list[bytes]:
    return [text[k : k + WINDOW] for k in range(0, len(text), WINDOW)]


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, every: bool = False) -> ByteNetwork | None:
    """A network trained on all windows of the sample, or of ``every`` labelled document, but those that calibrate ``least``."""
    named = labelled(docs)
    slot = F.pmod(F.shiftright("u", 34), F.lit(CHECKED * ROUNDS)).cast("int")  # other bits than those the start is chosen by
    sizes = named.groupBy("lang", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    counts: dict[str, int] = {}
    for r in sizes:  # some rows per language
        counts[r["lang"]] = counts.get(r["lang"], 0) + r["n"]
    if not counts:
        return None
    # never below the chance of the number of languages, nor near what any clean text has shown
    chance = 1 / len(counts) if len(counts) > 1 else 0.0
    net = ByteNetwork(sorted(counts))
    if not every or max(counts.values()) <= per_language:
        rows = chosen(named, counts, per_language)
        learn(net, [x for k, x in enumerate(rows) if k % CHECKED or len(rows) <= CHECKED])
        low = net.pooled(*joined([text for k, (_, text) in enumerate(rows) if k % CHECKED == 0])).max(1)
        net.least = max(chance, MARGIN * float(low.min()) if len(low) >= ENOUGH else 0.0)
        return net
    learned = {r["lang"] for r in sizes if r["slot"] >= ROUNDS}
    checked = (slot < ROUNDS) & F.col("lang").isin(*learned)  # a language without other texts is learned from these
    rest = {k: sum(r["n"] for r in sizes if r["lang"] == k and (r["slot"] >= ROUNDS or k not in learned)) for k in counts}
    learn(net, chosen(named.where(~checked), rest, per_language))
    trimmed()  # the driver goes on, through all stages to come
    for k in range(ROUNDS):
        total: dict[str, int] = {}
        for r in sizes:
            if r["slot"] % ROUNDS == k and (r["slot"] >= ROUNDS or r["lang"] not in learned):
                total[r["lang"]] = total.get(r["lang"], 0) + r["bytes"]
        if total:
            net.step(gradient(net, named.where(~checked & (slot % ROUNDS == k)).select("lang", "text"), total))
    low = lowest(net, named.where(checked).select("text"))
    net.least = max(chance, MARGIN * low["p"] if low["n"] >= ENOUGH else 0.0)
    return net


def learn(net: ByteNetwork, rows: list[tuple[str, bytes]]) -> None:
    seen = [(net.languages.index(lang), w) for lang, text in rows for w in windows(text)]
    net.train([w for _, w in seen], np.array([k for k, _ in seen]))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and where each text starts and how long it is."""
    sizes = np.array([len(x) for x in texts])
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def gradient(net: ByteNetwork, rows: DataFrame, total: dict[str, int]) -> dict[str, np.ndarray]:
    """The gradient of the cross-entropy over every byte of ``rows`` (lang, text), each language weighing as much.

    ``total`` has the bytes of each language. A task sums over its windows, Spark over the tasks.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        wait: dict[str, list[bytes]] = {}
        sums = None
        reused(True)
        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                wait.setdefault(lang, []).extend(windows(text.encode()))
                while len(wait[lang]) >= AT_ONCE:
                    sums = more(sums, lang, wait[lang][:AT_ONCE])
                    del wait[lang][:AT_ONCE]
        for lang, left in wait.items():
            if left:
                sums = more(sums, lang, left)
        reused(False)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["at", "value"])

    def more(sums, lang, some):
        got = net.gradients(padded(some), np.full(len(some), net.languages.index(lang)))
        flat = np.concatenate([got[k].ravel() for k in net.p]).astype(float) * (sum(map(len, some)) / total[lang] / len(total))
        return flat if sums is None else sums + flat

    got = rows.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()  # a row per weight
    flat = np.zeros(sum(a.size for a in net.p.values()))
    flat[[r["at"] for r in got]] = [r["value"] for r in got]
    ends = np.cumsum([a.size for a in net.p.values()])
    return {k: flat[hi - a.size : hi].reshape(a.shape) for (k, a), hi in zip(net.p.items(), ends, strict=True)}


def lowest(net: ByteNetwork, rows: DataFrame) -> Row:
    """``n, p``: how many texts there are, and the lowest of their highest mean probabilities."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            if b.num_rows:
                top = net.pooled(*joined([x.encode() for x in b.column(0).to_pylist()])).max(1)
                yield pa.RecordBatch.from_arrays([pa.array([len(top)]), pa.array([float(top.min())])], names=["n", "p"])

    return rows.mapInArrow(run, "n long, p double").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.min("p"), F.lit(0.0)).alias("p")).first()


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    net = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), per_language)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("spoken"))
    schema = rows.select("doc_id").schema.add("lang_pred", "string").add("score", "double")
    return predict(rows, net, schema).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def predict(rows: DataFrame, net: ByteNetwork | None, schema) -> DataFrame:
    """``rows``: id, text, whether it has a letter."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in slices(batches):
            spoken = b.column(2).to_numpy(zero_copy_only=False)
            best, top = np.full(len(spoken), UNKNOWN, object), np.zeros(len(spoken))
            if net is not None and spoken.any():
                text = b.column(1).cast(pa.large_string())
                bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                data = np.frombuffer(text.buffers()[2], np.uint8)
                q = net.pooled(data, bounds[:-1][spoken], np.diff(bounds)[spoken])
                best[spoken], top[spoken] = np.array(net.languages, object)[q.argmax(1)], np.clip(q.max(1), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.string()), pa.array(top)], names=schema.names)

    return rows.mapInArrow(run, schema)


def accepted(docs: DataFrame, least: float | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows whose language could be told: not ``und``, mean probability of ``least`` (default: as calibrated) or more."""
    net = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), per_language, every=True)
    least = (net.least if net else 1.0) if least is None else least
    names = docs.columns
    flat = docs.toDF(*(f"c{k}" for k in range(len(names))))  # any names, clashing ones too
    text = flat[f"c{names.index(text_col)}"]
    rows = flat.withColumn("spoken", F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))
    schema = flat.schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in slices(batches):
            spoken = b.column(len(names)).to_numpy(zero_copy_only=False)
            keep = np.zeros(len(spoken), bool)
            if net is not None and spoken.any():
                column = b.column(names.index(text_col)).cast(pa.large_string())
                bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
                q = net.pooled(np.frombuffer(column.buffers()[2], np.uint8), bounds[:-1][spoken], np.diff(bounds)[spoken])
                keep[spoken] = q.max(1) >= least
            yield b.filter(pa.array(keep)).select(list(range(len(names)))) if len(spoken) else b.select(list(range(len(names))))

    return rows.mapInArrow(run, schema).toDF(*names)
