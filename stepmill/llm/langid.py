"""Language identification by interpolated Kneser-Ney character language models.

Texts are read as lower-case letters with every run of other characters as one blank. An n-gram of up to
four characters is one 64-bit number (16 bits a character; characters beyond 16 bits are folded), so
the models are sorted arrays of such hashes with a count per language, searched by bisection.

Counting looks at every labelled training text: each task counts 4-grams in numpy and hands on sums,
and Spark adds them up; the lower orders count distinct left neighbours in Spark too. The driver gathers
all counts, none left out: the n-grams each language really has, 14 bytes each, whatever others have. They
grow with the kinds of n-grams, not with the text, and must fit into a process's memory.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmill.llm.common import fresh, text_of
from stepmill.session import materialise, quoted, small_table

ORDER = 4
BLANK = 32
#: Characters are handled in runs of this many, so a very long text needs no more memory than a short one.
RUN = 1 << 19

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point the 16-bit number of its lower-case letter, or BLANK if it isn't a letter."""
    if "letters" not in _tables:
        codes = np.full(0x110000, BLANK, np.uint16)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = ord(char.lower()[0])
                codes[point] = max((low ^ (low >> 16) * 0x9E3) & 0xFFFF, BLANK + 1)
        _tables["letters"] = codes
    return _tables["letters"]


def _codes(text: str) -> np.ndarray:
    """A blank, then the letters with single blanks between words."""
    points = np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[points]
    blank = codes == BLANK
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep]


def _runs(texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts in pieces of at most RUN characters: numbers of the texts, 4-grams, and where each text ends.

    Pieces of a long text overlap by three characters, so every 4-gram comes exactly once.
    """
    owner, parts, ends, size = [], [], [], 0

    def packed():
        grams = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return owner, grams, np.array(ends, np.int64)

    for i, text in enumerate(texts):
        if not text:
            continue
        codes = _codes(text)
        if len(codes) < 3:
            continue
        # Two more blanks in front give the first letters full contexts.
        codes = np.concatenate([np.full(2, BLANK, np.uint16), codes])
        for at in range(0, len(codes) - 3, RUN):
            c = codes[at : at + RUN + 3].astype(np.uint64)
            grams = c[:-3] << np.uint64(48) | c[1:-2] << np.uint64(32) | c[2:-1] << np.uint64(16) | c[3:]
            owner.append(i)
            parts.append(grams)
            size += len(grams)
            ends.append(size)
            if size >= RUN:
                yield packed()
                owner, parts, ends, size = [], [], [], 0
    if parts:
        yield packed()


def _distinct(grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct 4-grams, how often each comes, and for each position the number of its 4-gram.

    With at most 64 different characters (any alphabet) this is counting in a table, else sorting.
    """
    last = (grams & np.uint64(0xFFFF)).astype(np.int64)
    there = np.bincount(last, minlength=1 << 16)
    for shift in (16, 32, 48):  # a piece's first context has characters that end no 4-gram
        there[(grams[starts] >> np.uint64(shift) & np.uint64(0xFFFF)).astype(np.int64)] += 1
    symbols = np.flatnonzero(there)
    if len(symbols) > 64:
        kinds, of, counts = np.unique(grams, return_inverse=True, return_counts=True)
        return kinds, counts, of
    short = np.zeros(1 << 16, np.int32)
    short[symbols] = np.arange(len(symbols))
    packed = np.zeros(len(grams), np.int32)
    for shift in (48, 32, 16, 0):
        packed *= len(symbols)
        packed += short[grams >> np.uint64(shift) & np.uint64(0xFFFF)]
    counts = np.bincount(packed, minlength=len(symbols) ** 4)
    found = np.flatnonzero(counts)
    number = np.zeros(len(counts), np.int32)
    number[found] = np.arange(len(found))
    rest, kinds = found.copy(), np.zeros(len(found), np.uint64)
    for shift in (0, 16, 32, 48):
        kinds |= symbols[rest % len(symbols)].astype(np.uint64) << np.uint64(shift)
        rest //= len(symbols)
    return kinds, counts[found], number[packed]


@dataclass
class Settings:
    """Bounds of the model: languages."""

    max_languages: int = 1_000


@dataclass
class Sparse:
    """Numbers by sorted key and language; what isn't there is 0."""

    keys: np.ndarray
    starts: np.ndarray  # of each key's entries, and their end
    of: np.ndarray  # the languages
    values: np.ndarray

    def rows(self, wanted: np.ndarray, languages: int) -> np.ndarray:
        """[wanted key, language]"""
        out = np.zeros((len(wanted), languages))
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = np.flatnonzero(self.keys[at] == wanted)
        first, size = self.starts[at[there]], self.starts[at[there] + 1] - self.starts[at[there]]
        entries = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        out[np.repeat(there, size), self.of[entries]] = self.values[entries]
        return out


def _sparse(keys: np.ndarray, of: np.ndarray, values: np.ndarray) -> Sparse:
    """From entries sorted by key and language; those of the same key and language are added up."""
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])]) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(values, new, dtype=np.float64).astype(np.float32) if len(keys) else np.zeros(0, np.float32)
    keys, of = keys[new], of[new]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return Sparse(keys[starts], np.r_[starts, len(keys)], of, sums)


@dataclass
class Model:
    languages: list[str]
    counts: list[Sparse]  # per order 1..4
    totals: list[Sparse]  # by context (order 1: the one context 0)
    followers: list[Sparse]
    discounts: np.ndarray  # [order, language]
    sharpness: float = 1.0
    limits: np.ndarray | None = None  # the largest accepted cross-entropy a language

    def log_prob(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last character after the first three, [n-gram, language]."""
        probability = np.full((len(grams), len(self.languages)), 1.0 / (len(self.counts[0].keys) + 1))
        for n in range(1, ORDER + 1):
            suffix = grams & np.uint64((1 << 16 * n) - 1)
            count, total, kinds = (
                table[n - 1].rows(wanted, len(self.languages))
                for table, wanted in ((self.counts, suffix), (self.totals, suffix >> np.uint64(16)), (self.followers, suffix >> np.uint64(16)))
            )
            d = self.discounts[n - 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                mixed = (np.maximum(count - d, 0) + d * kinds * probability) / total
            probability = np.where(total > 0, mixed, probability)
        return np.log(np.maximum(probability, 1e-12))

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy a character, [text, language], and the number of characters that were scored."""
        sums, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for owner, grams, ends in _runs(texts):
            starts = np.concatenate([[0], ends[:-1]])
            kinds, _, of = _distinct(grams, starts)
            scores = self.log_prob(kinds).astype(np.float32)
            for k in range(len(self.languages)):
                np.add.at(sums[:, k], owner, np.add.reduceat(scores[of, k].astype(np.float64), starts))
            np.add.at(sizes, owner, ends - starts)
        return -sums / np.maximum(sizes, 1)[:, None], sizes

    def judge(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
        """Best language (None without a letter), its probability, its cross-entropy, accepted or not."""
        if not self.languages:
            return [None] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, sizes = self.entropies(texts)
        best = entropy.argmin(1)
        relative = np.exp(-(entropy - entropy.min(1, keepdims=True)) * self.sharpness)
        score = 1 / relative.sum(1)
        chosen = entropy[np.arange(len(texts)), best]
        spoken = sizes > 0
        accepted = spoken & (chosen <= self._limit(best, sizes))
        names = [self.languages[b] if s else None for b, s in zip(best, spoken, strict=True)]
        return names, np.where(spoken, score, 0.0), np.where(spoken, chosen, 0.0), accepted

    def _limit(self, best: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.limits is None:
            return np.full(len(best), np.inf)
        mean, spread, slack = self.limits[:, best]
        return mean + slack + spread * 8 / np.sqrt(np.maximum(sizes, 1))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, text) to (language, 4-gram, count), added up batch by batch."""
    for batch in batches:
        frame = batch.to_pandas()
        for lang, texts in frame.groupby("lang", sort=False)["text"]:
            for _, grams, ends in _runs(texts.tolist()):
                kinds, counts, _ = _distinct(grams, np.concatenate([[0], ends[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kinds)), pa.array(kinds.view(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


def _gathered(grams: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams, the numbers of their languages, and their counts."""
    numbers = small_table(grams.sparkSession, {"lang": languages, "of": list(range(len(languages)))}, {"lang": pa.string(), "of": pa.int16()})
    table = grams.join(F.broadcast(numbers), "lang").select("gram", "of", F.col("n").cast("float")).toArrow()
    return table.column("gram").to_numpy().view(np.uint64), table.column("of").to_numpy(), table.column("n").to_numpy()


def train(docs: DataFrame, learn: Column, *, text: str = "text", lang: str = "lang", key: str = "doc_id", settings: Settings | None = None) -> Model:
    """Count and calibrate on the rows where ``learn`` is true and text and language aren't null.

    Without such rows the model has no language and judges nothing. Calibration (sharpness of the
    probabilities, each language's own limits for rejection) uses all these texts once more.
    """
    settings = settings or Settings()
    rows = docs.filter(learn).select(F.col(quoted(key)).alias("key"), F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text")).dropna(subset=["lang", "text"])
    top = materialise(
        rows.select("lang", "text").mapInArrow(_count_grams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    frames = {ORDER: top}
    for n in range(ORDER - 1, 0, -1):
        frames[n] = frames[n + 1].groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("gram")).agg(F.count("*").alias("n"))
    languages = sorted(r["lang"] for r in top.select("lang").distinct().limit(settings.max_languages + 1).collect())
    if len(languages) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages; raise max_languages if that is meant")
    model = build(languages, (_gathered(frames[n], languages) for n in range(1, ORDER + 1)))
    calibrate(model, rows)
    return model


def build(languages: list[str], orders: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """From all n-grams of each order, the numbers of their languages, and their counts."""
    model = Model(languages, [], [], [], np.full((ORDER, len(languages)), 0.5))
    for n, (grams, of, counts) in enumerate(orders):
        once, twice = (np.bincount(of[counts == c], minlength=len(languages)) for c in (1, 2))
        model.discounts[n] = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5).clip(0.1, 0.95)
        order = np.lexsort((of, grams))
        model.counts.append(_sparse(grams[order], of[order], counts[order]))
        context = grams >> np.uint64(16)
        order = np.lexsort((of, context))
        context, of = context[order], of[order]
        model.totals.append(_sparse(context, of, counts[order]))
        model.followers.append(_sparse(context, of, np.ones(len(of), np.float32)))
    return model


def calibrate(model: Model, rows: DataFrame) -> None:
    """From all known texts (``lang``, ``text``). Sharpness: the one with the best log score. Limits: from the spread of the cross-entropies of a language's own texts."""
    if not model.languages:
        return
    held = rows.sparkSession.sparkContext.broadcast(model)
    number = {name: i for i, name in enumerate(model.languages)}
    sharpness = (1, 2, 4, 8, 16, 32)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                entropy, sizes = held.value.entropies(part["text"].tolist())
                known = part["lang"].map(number).to_numpy()
                use = (sizes > 0) & ~pd.isna(known)
                entropy, known = entropy[use], known[use].astype(int)
                places = np.arange(len(known))
                relative = entropy - entropy.min(1, keepdims=True)
                losses = {f"loss{s}": relative[places, known] * s + np.log(np.exp(-relative * s).sum(1)) for s in sharpness}
                yield pd.DataFrame({"of": known, "own": entropy[places, known], **losses})

    names = [f"loss{s}" for s in sharpness]
    seen = (
        rows.select("lang", "text")
        .mapInPandas(scored, "of int, own double, " + ", ".join(f"{n} double" for n in names))
        .groupBy("of")
        .agg(F.percentile_approx("own", [0.5, 0.99], 10_000).alias("at"), *[F.sum(n).alias(n) for n in names])
        .collect()
    )
    if not seen:
        return
    model.sharpness = float(min(sharpness, key=lambda s: sum(r[f"loss{s}"] for r in seen)))
    # Every language has learned from texts of its own, so each has its own limits.
    model.limits = np.zeros((3, len(model.languages)))
    for r in seen:
        middle, high = r["at"]
        # A character's own surprise spreads over about two nats; half a nat is left for style.
        model.limits[:, r["of"]] = middle, 2.0, 0.5 + high - middle


#: What ``identify`` adds.
ADDED = ("lang_pred", "score", "entropy", "accepted")


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1), ``entropy`` (nats a character) and ``accepted`` to all rows.

    A null text or one without a letter gives ``und``, score 0 and no acceptance. Ties go to the first
    language by name. A text is refused when the best model's cross-entropy lies beyond what texts of
    its length and language show. Existing columns of these names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [quoted(c) for c in docs.columns if c.lower() not in ADDED]
    judgement = fresh(docs, "_judged")

    @F.pandas_udf("lang_pred string, score double, entropy double, accepted boolean")
    def judged(texts: pd.Series) -> pd.DataFrame:
        parts = []
        for at in range(0, len(texts), 1024):
            names, score, entropy, accepted = held.value.judge(texts.iloc[at : at + 1024].tolist())
            parts.append(pd.DataFrame({"lang_pred": [n or "und" for n in names], "score": score, "entropy": entropy, "accepted": accepted}))
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in ADDED})

    return docs.select("*", judged(text_of(text)).alias(judgement)).select(*kept, f"{judgement}.*")


def held_out(key: Column) -> Column:
    """Every fourth document by CRC of its id is kept from learning; a null id is neither."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2
