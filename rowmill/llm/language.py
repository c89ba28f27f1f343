"""Language identification by error-correcting output codes.

Each language has a codeword of bits, far from all others. For each bit a linear classifier
over byte n-grams tells languages with a 1 from those with a 0; its weights are the log odds
of the n-grams. A text's bits are decoded to the nearest codeword by their loss, each bit
weighted by how well it is told on labelled texts of that language. A text whose two best
codewords are close is flagged. Whether a text is in its language at all is told by how
likely its n-grams are there, against the labelled texts' own likelihoods by length.

Fitted on at most ``SAMPLE`` labelled texts of each language (in expectation), picked by a
hash of their id; whole texts count. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.arrays import mix, pieces
from rowmill.llm.frames import written

SAMPLE = 5000
SLOTS = 1 << 13
ORDERS = (2, 3)
UNKNOWN = "und"
AMBIGUOUS = 0.6
SHARPNESS = 6.0
RARE = 0.001
SLACK = 1.2
#: Room of a short text in any case, in log chance times the root of its n-grams.
SHORT = 3.0
_AT_ONCE = 128


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit, +1 or -1
    weights: np.ndarray  # slot x bit
    bias: np.ndarray  # bit
    scale: np.ndarray  # bit
    trust: np.ndarray  # language x bit, rows add up to 1
    grams: np.ndarray  # language x slot, labelled n-gram counts and a half
    usual: np.ndarray  # language: median mean log chance of an n-gram of a labelled text
    least: np.ndarray  # language: how far below that labelled texts are at most, whatever their length
    short: np.ndarray  # language: what of that, times the root of the number of n-grams, short texts have more

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return ((counts @ self.weights) / total - self.bias) / self.scale

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each codeword, text x language."""
        m = np.clip(self.margins(counts), -4, 4)
        return np.stack([np.log1p(np.exp(-2 * m * c)) @ t for c, t in zip(self.code, self.trust)], axis=1)

    def decide(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest codeword, and a score from 0 to 1 of how clearly it is the nearest."""
        loss = self.losses(counts)
        best = loss.argmin(axis=1)
        odds = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        return best, 1 / odds.sum(axis=1)


    def likelihoods(self, counts: np.ndarray, of: np.ndarray, own: bool = False) -> np.ndarray:
        """Mean log chance of a text's n-grams in its language; ``own`` texts are taken out of its counts."""
        out = np.zeros(len(counts))
        for k, (row, lang) in enumerate(zip(counts, of)):
            slot = np.flatnonzero(row)
            times = row[slot]
            rest = self.grams[lang, slot] - (times if own else 0)
            total = self.grams[lang].sum() - (times.sum() if own else 0)
            out[k] = (times * np.log(rest / total)).sum() / max(times.sum(), 1)
        return out

    def belongs(self, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether texts are as likely in their language as labelled ones of their length are."""
        room = self.least[best] + self.short[best] / np.sqrt(np.maximum(counts.sum(axis=1), 1))
        return self.usual[best] - self.likelihoods(counts, best) <= room


def codewords(languages: int) -> np.ndarray:
    """+1/-1 codewords, the best of 500 tries by least distance between any two.

    Every bit is 1 for some languages and 0 for others, and no bit is another's complement
    where there are enough different ones.
    """
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    bits = min(2 ** (languages - 1) - 1, 8 + 3 * languages.bit_length()) if languages < 32 else 3 * languages.bit_length() + 16
    rnd = np.random.default_rng(20)
    best, reach = None, -1
    for _ in range(500):
        seen, columns = set(), []
        while len(columns) < bits:
            column = rnd.integers(0, 2, languages)
            column = column ^ column[0]
            if column.any() and (column.tobytes() not in seen or languages >= 32):
                seen.add(column.tobytes())
                columns.append(column)
        code = np.array(columns).T
        signs = 2 * code - 1
        distance = (bits - signs @ signs.T) // 2 + np.eye(languages, dtype=int) * bits
        if distance.min() > reach:
            best, reach = signs, distance.min()
        if languages > 200:
            break
    return best.astype(np.int8)


def _counts(texts: list[str | None]) -> np.ndarray:
    """n-gram counts of a few texts, text x slot."""
    raw = [f" {t.lower()} ".encode() if t else b"" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    of = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    out = np.zeros(len(raw) * SLOTS, np.int64)
    value = data
    for order in range(2, max(ORDERS) + 1):
        if len(data) < order:
            break
        value = (value[:-1] << np.uint64(8)) | data[order - 1 :]
        if order in ORDERS:
            whole = of[: len(value)] == of[order - 1 :]
            slot = (mix(value[whole] + np.uint64(order << 56)) >> np.uint64(51)).astype(np.int64)
            out += np.bincount(of[: len(value)][whole] * SLOTS + slot, minlength=len(out))
    return out.reshape(len(raw), SLOTS)


def _few(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for part in pieces(batches, "text"):
        for start in range(0, part.num_rows, _AT_ONCE):
            rows = part.slice(start, _AT_ONCE)
            yield rows, _counts(rows.column("text").to_pylist())


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> Model:
    """Fit to the rows with a text, an id and a language. With none, no language is known."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"
    )
    sizes = rows.groupBy("lang").count().collect()  # a row for each language, as the model has
    shares = {r["lang"]: min(1.0, sample / r["count"]) for r in sizes}
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")] if shares else F.lit(0.0)
    place = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    picked = written(rows.where(place < share).select("text", "lang"), "labelled")

    def gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part, counts in _few(batches):
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in set(langs):
                total[lang] = total.get(lang, 0) + counts[langs == lang].sum(axis=0)
        for lang, counts in total.items():
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(slot), "slot": slot.astype(np.int32), "n": counts[slot]})

    found = picked.mapInArrow(gram_counts, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    code = codewords(len(languages))
    counts = np.zeros((len(languages), SLOTS))
    counts[np.searchsorted(languages, found["lang"].to_numpy(str)), found["slot"]] = found["n"]
    chance = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    bits = code.shape[1]
    weights, bias, scale = np.zeros((SLOTS, bits)), np.zeros(bits), np.ones(bits)
    for b in range(bits) if len(languages) > 1 else ():
        one, zero = chance[code[:, b] > 0], chance[code[:, b] < 0]
        weights[:, b] = np.log(one.mean(axis=0)) - np.log(zero.mean(axis=0))
        high, low = (one @ weights[:, b]).min(), (zero @ weights[:, b]).max()
        bias[b], scale[b] = (high + low) / 2, max(abs(high - low) / 2, 1e-6)
    none = np.zeros(len(languages))
    model = Model(languages, code, weights, bias, scale, np.full(code.shape, 1.0), counts + 0.5, none, none.copy(), none.copy())
    if len(languages) > 1:
        model.trust = _trust(picked, model)
    if languages:
        _bounds(picked, model)
    return model


def _bounds(picked: DataFrame, model: Model) -> None:
    """What the labelled texts of each language leave room for: the share ``RARE`` of them that
    is the least likely is not counted, and there is ``SLACK`` times the rest's room."""

    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts in _few(batches):
            of = np.searchsorted(model.languages, np.array(part.column("lang").to_pylist(), str))
            yield pa.RecordBatch.from_pydict({"lang": of, "n": counts.sum(axis=1), "mean": model.likelihoods(counts, of, own=True)})

    rated = picked.where(F.col("text").rlike(r"\p{L}")).mapInArrow(rate, "lang bigint, n bigint, mean double").where("n > 0").toPandas()
    for lang, own in rated.groupby("lang"):
        n, mean = own["n"].to_numpy(), own["mean"].to_numpy()
        model.usual[lang] = np.median(mean)
        below = model.usual[lang] - mean
        long = n >= np.median(n)
        model.least[lang] = SLACK * max(np.quantile(below[long], 1 - RARE), 0)
        model.short[lang] = max(np.quantile((SLACK * below - model.least[lang]) * np.sqrt(n), 1 - RARE), SHORT)


def _trust(picked: DataFrame, model: Model) -> np.ndarray:
    """How often each bit is told right on the labelled texts of each language."""

    def right(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, counts in _few(batches):
            of = np.searchsorted(model.languages, np.array(part.column("lang").to_pylist(), str))
            good = (np.sign(model.margins(counts)) == model.code[of]).astype(np.int64)
            row, bit = (x.ravel() for x in np.indices(good.shape))
            yield pa.RecordBatch.from_pydict({"lang": of[row].astype(np.int32), "bit": bit.astype(np.int32), "good": good.ravel()})

    rows = picked.mapInArrow(right, "lang int, bit int, good bigint").groupBy("lang", "bit").agg(F.avg("good").alias("good")).toPandas()
    trust = np.full(model.code.shape, 1e-3)
    trust[rows["lang"], rows["bit"]] = np.maximum(rows["good"].to_numpy() - 0.5, 1e-3)
    return trust / trust.sum(axis=1, keepdims=True)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous, belongs): one row for each input row, from the text alone.

    ``belongs`` tells whether the text is as likely in that language as labelled ones are.
    A null text or one without a letter is ``und`` with score 0, as is every text where no
    language was learned. Ids may be null or repeated; other columns are left out whatever
    their names.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, counts in _few(batches):
            letters = np.array(rows.column("letters").to_pylist(), bool)
            names, scores = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            belongs = np.zeros(len(letters), bool)
            if model.languages and letters.any():
                best, score = model.decide(counts[letters])
                names[letters], scores[letters] = np.array(model.languages, object)[best], score
                belongs[letters] = model.belongs(counts[letters], best)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(names, pa.string()), pa.array(scores), pa.array(letters & (scores < AMBIGUOUS)), pa.array(belongs)],
                ["id", "lang_pred", "score", "ambiguous", "belongs"],
            )

    texts = df.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters")
    )
    schema = T.StructType(
        [texts.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType()), T.StructField("belongs", T.BooleanType())]
    )
    return texts.mapInArrow(run, schema)
