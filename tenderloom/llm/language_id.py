"""Language identification with interpolated Kneser-Ney character models.

One model per language, over the characters of words between two boundary
signs.  Probabilities of observed n-grams and back-off weights of observed
contexts lie in arrays sorted by a hash of the n-gram; a lookup searches from
the place that the hash's leading bits give.  A text's cross-entropy is that of all its words divided by their
characters, so words are scored once while they stay in a cache.

The models learn from a bounded sample of labelled rows (``DOCS_PER_LANG``
documents of each language, those with the smallest hash of their id); a
quarter of it is not counted but calibrates the rejection: a text goes that
costs as much under the best model as other languages' texts do, with more
room the shorter it is.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BASES, MASK, SHORT, mix, powers, short_keys, slices, string_buffers, prepared_tasks, trimmed, words

ORDER = 5
DOCS_PER_LANG = 400
#: Rejection: the quantile of foreign texts' costs that sets the level, deviations of room for short texts, least level,
#: words of a short piece; mean, noise and level where nothing was held back.
NEAREST, DEVIATIONS, LEAST_LEVEL, PIECE = 0.05, 4.0, 0.75, 10
NO_SAMPLE = (2.5, 2.0, 1.5)
SHARPNESS = 12.0
NO_LANGUAGE = "und"
BEGIN, END = "\x02", "\x03"
PLACES = 1 << 19

# bytes that are no letters: ASCII without a-z; texts are lower-cased before
OTHER = np.ones(256, bool)
OTHER[ord("a") : ord("z") + 1] = False
OTHER[0x80:] = False


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order: a hash of the n characters that end at each place."""
    weight = powers(BASES[1], order + 1)
    codes = codes.astype(np.uint64) + np.uint64(1)
    value, out = np.zeros(len(codes), np.uint64), []
    for n in range(1, order + 1):
        moved = np.zeros(len(codes), np.uint64)
        moved[n - 1 :] = codes[: max(0, len(codes) - n + 1)]
        value = value + moved * weight[n - 1]
        out.append(mix(value + np.uint64(n)))
    return out


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class CharacterModel:
    """Sorted hashes of n-grams with their probability, sorted hashes of contexts with their back-off weight."""

    grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    floor: float = 1e-4

    @classmethod
    def fitted(cls, counts: dict[str, int], order: int = ORDER) -> CharacterModel:
        """counts: how often each word occurs."""
        raw = [Counter() for _ in range(order + 1)]
        for word, k in counts.items():
            padded = BEGIN + word + END
            for n in range(1, order + 1):
                for i in range(max(0, 2 - n), len(padded) - n + 1):
                    raw[n][padded[i : i + n]] += k
        used = [Counter() for _ in range(order + 1)]
        used[order] = raw[order]
        for n in range(1, order):
            used[n] = Counter({g: c for g, c in raw[n].items() if g[0] == BEGIN and n > 1})
            for g in raw[n + 1]:
                used[n][g[1:]] += 1
        model = cls(floor=1.0 / (len(used[1]) + 1000))
        before: dict[str, float] = {}
        for n in range(1, order + 1):
            ones, twos = (sum(c == k for c in used[n].values()) for k in (1, 2))
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total, kinds = defaultdict(float), defaultdict(int)
            for g, c in used[n].items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            back = {h: discount * kinds[h] / total[h] for h in total}
            now = {}
            for g, c in used[n].items():
                lower = before.get(g[1:], model.floor) if n > 1 else model.floor
                now[g] = max(c - discount, 0.0) / total[g[:-1]] + back[g[:-1]] * lower
            model.grams.append(cls.table(now, n))
            model.contexts.append(cls.table(back, n - 1))
            before = now
        return model

    @staticmethod
    def table(values: dict[str, float], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending hashes with a last one beyond all, their values, and where the hashes with each leading bits begin."""
        if n == 0:
            return np.zeros(1, np.uint64), np.array(list(values.values()) or [1.0]), np.zeros(1, np.int64)
        keys = gram_hashes(codes_of("".join(values)), n)[n - 1][n - 1 :: n] if values else np.zeros(0, np.uint64)
        order = np.argsort(keys)
        bits = max(1, len(keys).bit_length())
        first = np.searchsorted(keys[order], np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        return np.append(keys[order], np.uint64(MASK)), np.append(np.fromiter(values.values(), float, len(values))[order], 1.0), first

    @staticmethod
    def find(table: tuple[np.ndarray, np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its value: a search from the place that its leading bits give."""
        have, values, first = table
        at = first[(keys >> np.uint64(65 - len(first).bit_length())).astype(np.int64)]
        on = np.flatnonzero(have[at] < keys)
        while len(on):
            at[on] += 1
            on = on[have[at[on]] < keys[on]]
        return have[at] == keys, values[at]

    def log_probabilities(self, hashes: list[np.ndarray], place: np.ndarray) -> np.ndarray:
        """ln p of the character at each place; place: how many characters of its word stand before it."""
        p = np.full(len(place), self.floor)
        for n, (grams, contexts) in enumerate(zip(self.grams, self.contexts), 1):
            fits = np.flatnonzero(place >= n - 1)
            known, value = self.find(grams, hashes[n - 1][fits])
            if n > 1:
                context = np.zeros(len(place), np.uint64)
                context[1:] = hashes[n - 2][:-1]
                seen, weight = self.find(contexts, context[fits])
                back = np.where(seen, weight, 1.0)
            else:
                back = contexts[1][0]
            p[fits] = np.where(known, value, back * p[fits])
        return np.log(p)


class WordScores:
    """What words cost under one set of models; one table per process, for the models used last.

    Words of up to ``SHORT`` bytes lie under their own bytes in a table of
    ``PLACES``, a newcomer in place of the one before; long ones are scored
    once a call.
    """

    owner: str | None = None

    def of(self, models: LanguageModels, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One row per word; ``data`` has 16 bytes more than the words reach."""
        if self.owner != models.key:
            self.owner = models.key
            self.low, self.high = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint64)
            self.rows = np.zeros((PLACES, len(models.models)))
        size = ends - starts
        low, high = short_keys(data, starts, np.minimum(size, SHORT))
        slot = (mix(low ^ high * np.uint64(BASES[0])) >> np.uint64(65 - PLACES.bit_length())).astype(np.int64)
        short = size <= SHORT
        hit = short & (self.low[slot] == low) & (self.high[slot] == high)
        out = self.rows[slot]
        new = np.flatnonzero(~hit)
        if len(new):
            seen: dict[bytes, int] = {}
            own = np.array([seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            found = models.of_words([w.decode() for w in seen])
            out[new] = found[own]
            kept = new[short[new]]
            self.low[slot[kept]], self.high[slot[kept]], self.rows[slot[kept]] = low[kept], high[kept], out[kept]
        return out


_known = WordScores()


@dataclass
class LanguageModels:
    names: list[str]
    models: list[CharacterModel]
    mean: np.ndarray = None  # of the cross-entropies of each language's texts
    level: np.ndarray = None  # how far above it a long text is rejected
    noise: np.ndarray = None  # deviation of one character's cost: short texts get more room
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def calibrate(self, lang: np.ndarray, entropy: np.ndarray, size: np.ndarray) -> None:
        """Levels of rejection from held-back texts (rows: cross-entropy under each model).

        A language's own texts lie around ``mean``.  Texts of the other
        languages show what foreign ones look like under its model: the level
        is where the nearest of those begin.
        """
        k = len(self.names)
        own = [entropy[lang == i, i] for i in range(k)]
        self.mean = np.array([np.median(x) if len(x) else NO_SAMPLE[0] for x in own])
        self.noise = np.array([np.sqrt(np.mean((x - m) ** 2 * size[lang == i])) if len(x) >= 5 else NO_SAMPLE[1] for i, (x, m) in enumerate(zip(own, self.mean))])
        foreign = [entropy[lang != i, i] - self.mean[i] for i in range(k)]
        self.level = np.array([max(np.quantile(x, NEAREST), LEAST_LEVEL) if len(x) >= 5 else NO_SAMPLE[2] for x in foreign])

    def of_words(self, found: list[str]) -> np.ndarray:
        """Per word and language the sum of ln p of its characters and its end sign."""
        codes = codes_of("".join(f"{BEGIN}{w}{END}" for w in found))
        start = np.flatnonzero(codes == ord(BEGIN))
        place = np.arange(len(codes)) - np.repeat(start, np.diff(np.append(start, len(codes))))
        hashes = gram_hashes(codes, len(self.models[0].grams))
        out = np.empty((len(found), len(self.models)))
        for i, m in enumerate(self.models):
            value = m.log_probabilities(hashes, place)
            value[start] = 0
            out[:, i] = np.add.reduceat(value, start)
        return out

    def of_texts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per slice of rows: sums of ln p per language, and the number of characters."""
        data, offsets = string_buffers(pc.utf8_lower(texts))
        for lo, hi in slices(offsets):
            starts, ends, rows = words(data, offsets, lo, hi, OTHER)
            n = hi - lo
            if not len(starts):
                yield np.zeros((n, len(self.models))), np.zeros(n)
                continue
            a = int(starts[0])
            per = _known.of(self, np.append(data[a : int(ends[-1])], np.zeros(16, np.uint8)), starts - a, ends - a)
            sums = np.stack([np.bincount(rows - lo, per[:, i], n) for i in range(len(self.models))], 1)
            size = ends - starts
            # characters, not bytes: bytes that continue a code point don't count
            goes_on = np.append(0, np.cumsum((data[starts[0] : ends[-1]] & 0xC0) == 0x80))
            size = size - (goes_on[ends - starts[0]] - goes_on[starts - starts[0]])
            yield sums, np.bincount(rows - lo, size + 1, n)


def learning_sample(labelled: DataFrame, lang_col: str, id_col: str, most: int) -> DataFrame:
    """``most`` rows of each language at most, those with the smallest hash of their id."""
    space = 1 << 30
    labelled = labelled.withColumn("_order", F.pmod(F.xxhash64(F.col(id_col)), F.lit(space)))
    counts = labelled.groupBy(lang_col).count().collect()
    keep = F.lit(False)
    for r in counts:
        share = min(1.0, (2 * most + 50) / r["count"])
        keep = keep | ((F.col(lang_col) == r[lang_col]) & (F.col("_order") < int(share * space)))
    rank = F.row_number().over(Window.partitionBy(lang_col).orderBy("_order", id_col))
    return labelled.filter(keep).withColumn("_rank", rank).filter(F.col("_rank") <= most)


def fit_languages(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG, order: int = ORDER) -> LanguageModels | None:
    """Models of all languages in ``labelled`` (rows without language or text are ignored); None if there are none."""
    prepared_tasks(labelled.sparkSession)
    labelled = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("_lang"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sample = learning_sample(labelled, "_lang", "_id", docs_per_lang).withColumn("_level", F.col("_rank") % 4 == 0)

    def counted(batches):
        for batch in batches:
            out = Counter()
            data, offsets = string_buffers(pc.utf8_lower(batch.column("_text")))
            starts, ends, rows = words(data, offsets, 0, batch.num_rows, OTHER)
            langs = batch.column("_lang").to_pylist()
            for a, b, r in zip(starts.tolist(), ends.tolist(), rows.tolist()):
                out[langs[r], data[a:b].tobytes().decode()] += 1
            yield pa.record_batch([pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()), pa.array(list(out.values()), pa.int64())], ["lang", "word", "n"])

    # bounded by the sample
    found = sample.filter("not _level").select("_lang", "_text").mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    if found.empty:
        return None
    by = {lang: dict(zip(g["word"], g["n"])) for lang, g in found.groupby("lang")}
    names = sorted(by)
    fitted = LanguageModels(names, [CharacterModel.fitted(by[n], order) for n in names])

    def levels(batches):
        """Cross-entropies under all models of each held-back document, and of its first words alone."""
        for batch in batches:
            langs = batch.column("_lang").to_pylist()
            for texts in (batch.column("_text"), pc.binary_join(pc.list_slice(pc.utf8_split_whitespace(batch.column("_text")), 0, PIECE), " ")):
                sums, size = (np.concatenate(x) for x in zip(*fitted.of_texts(texts)))
                keep = [i for i, x in enumerate(langs) if x in fitted.names and size[i]]
                entropy = [(-sums[i] / size[i]).tolist() for i in keep]
                yield pa.record_batch([pa.array([fitted.names.index(langs[i]) for i in keep], pa.int32()), pa.array(entropy, pa.list_(pa.float64())), pa.array([size[i] for i in keep], pa.float64())], ["lang", "entropy", "size"])

    level = sample.filter("_level").select("_lang", "_text").mapInArrow(levels, "lang int, entropy array<double>, size double").toPandas()
    fitted.calibrate(level["lang"].to_numpy(int), np.array(level["entropy"].tolist()).reshape(-1, len(names)), level["size"].to_numpy(float))
    return fitted


def judged(own: LanguageModels | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy (NaN without a letter) and rejection of each text."""
    n = len(texts)
    lang, score, entropy, out = [NO_LANGUAGE] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
    if own is None or not n:
        return lang, score, entropy, out
    sums, size = (np.concatenate(x) for x in zip(*own.of_texts(texts)))
    plain = pc.match_substring_regex(texts.fill_null(""), "[A-Za-z]").to_numpy(zero_copy_only=False)
    some = np.array([i for i in np.flatnonzero(size > 0).tolist() if plain[i] or any(c.isalpha() for c in texts[i].as_py())], np.int64)
    h = -sums[some] / size[some, None]
    best = h.argmin(1) if len(some) else np.zeros(0, np.int64)
    low = h[np.arange(len(some)), best]
    room = own.level[best] + DEVIATIONS * own.noise[best] / np.sqrt(size[some])
    score[some] = 1 / np.exp(-SHARPNESS * (h - low[:, None])).sum(1)
    entropy[some] = low
    out[some] = low - own.mean[best] > room
    for i, k in zip(some.tolist(), best.tolist()):
        lang[i] = own.names[k]
    return lang, score, entropy, out


def identify(docs: DataFrame, models: LanguageModels | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, lang_pred, score (0 to 1), cross_entropy (nats a character), rejected.

    ``und`` with score 0, rejected, if the text is null, empty or without a
    letter, or if nothing could be learned.  score: how far the best language
    is ahead of the others.  rejected: also a text whose cross-entropy is far
    above that of texts in its language; short texts are given more room.
    Ties go to the language whose name sorts first.  Repeated rows are judged
    each, very long texts whole.  Other columns of ``docs`` are ignored; an
    empty table gives an empty result.
    """
    prepared_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kind = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, entropy, out = judged(shared.value, batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(out)], [id_col, "lang_pred", "score", "cross_entropy", "rejected"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(scored(batches)), f"`{id_col}` {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


def drop_rejected(docs: DataFrame, models: LanguageModels | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text ``identify`` does not reject, with all their columns; no shuffle."""
    prepared_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~judged(shared.value, batch.column(text_col).cast(pa.string()))[3], pa.bool_()))

    return docs.mapInArrow(lambda batches: trimmed(filtered(batches)), docs.schema)


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
