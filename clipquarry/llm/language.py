"""Language identification by known words, backing off to character n-grams.

Words are runs of letters in lower case. A word that the training texts know well is scored by the logarithm of its
share of each language's words. Any other word is scored by its character n-grams, of the longest length of
which some are known: four letters, then three, two, one, with marks for the ends of a word.

Counts cover all training texts: they are gathered per task, summed by language and word, and the n-grams are counted from that
table. The model keeps the most frequent words of each language, and n-grams of each language and length; how many is a
parameter. The least count that is kept whole is read off a table of counts of counts, and of the items with the next
count a share is picked by a hash, so nothing is ranked in one task and no group of ties falls out whole. The
model, whose size follows from its parameters and the number of languages, is sent to the executors."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipquarry.llm.common import WORKER_CACHE, store

MODEL_WORDS = 30_000  # words of the model for each language
MODEL_GRAMS = 30_000  # n-grams of the model for each language and length
SLICE = 256  # texts whose words are held at once
MEMO_CHARACTERS = 16 << 20  # of remembered words
HASHES = 1 << 30
LENGTHS = (4, 3, 2, 1)
SMOOTHING = 0.5
HELD = 300_000  # distinct words that a task holds before it passes their counts on
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _counted(rows: DataFrame, count) -> DataFrame:
    """``lang``, ``item``, ``n``: sums of what ``count`` adds to a counter per language, per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            tongues = [x for x, own in held.items() for _ in range(len(own))]
            items = [w for own in held.values() for w in own]
            counts = [n for own in held.values() for n in own.values()]
            held.clear()
            columns = [pa.array(tongues, pa.string()), pa.array(items, pa.string()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "item", "n"])

        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                count(batch.slice(i, SLICE), held)
                if sum(map(len, held.values())) > HELD:
                    yield out()
        yield out()

    return rows.mapInArrow(run, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame, *, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang``, ``item``, ``n``: the words of all texts with a language."""

    def count(batch: pa.RecordBatch, held: dict[str, Counter]) -> None:
        for tongue, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held.setdefault(tongue, Counter()).update(words_of(value))

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string"), text)
    return _counted(rows, count)


def count_grams(words: DataFrame) -> DataFrame:
    """``lang``, ``item``, ``n``: the n-grams of counted words."""

    def count(batch: pa.RecordBatch, held: dict[str, Counter]) -> None:
        for tongue, word, k in zip(*(c.to_pylist() for c in batch.columns)):
            own = held.setdefault(tongue, Counter())
            for n in LENGTHS:
                for g in grams(word, n):
                    own[g] += k

    return _counted(words.select("lang", "item", "n"), count)


def most_frequent(counts: DataFrame, entries: int, by: Sequence[str] = ("lang",)) -> DataFrame:
    """The rows of ``counts`` whose item is, for some value of ``by``, among the about ``entries`` most frequent. Where ties go
    over that, those with the smallest hashes stay, as many as there is room for on average."""
    spread = counts.groupBy(*by, F.col("n").alias("_n")).agg(F.count("*").alias("items"))
    down = Window.partitionBy(*by).orderBy(F.desc("_n"))  # counts of counts: one row per different count
    room = F.lit(entries) - F.col("reach") + F.col("items")
    least = (
        spread.withColumn("reach", F.sum("items").over(down))
        .where(room > 0)
        .select(*by, F.col("_n").alias("n"), F.least(F.lit(1.0), room / F.col("items")).alias("share"))
    )
    least = least.groupBy(*by).agg(F.min("n").alias("least"), F.min_by("share", "n").alias("share"))
    small = F.pmod(F.xxhash64("item"), F.lit(HASHES)) < F.col("share") * HASHES
    kept = counts.join(F.broadcast(least), [*by]).where((F.col("n") > F.col("least")) | (F.col("n") == F.col("least")) & small)
    return counts.join(kept.select("item").distinct(), "item", "left_semi")


class Model:
    """``known`` and ``by_gram``: of an item the row of its log shares; ``languages`` in order."""

    def __init__(self, languages: list[str], totals: dict[str, int], words: list, pieces: list, gram_totals: dict) -> None:
        self.languages = languages
        place = {x: i for i, x in enumerate(languages)}

        def table(rows: list, sums: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
            at: dict[str, int] = {}
            for _, item, _ in rows:
                at.setdefault(item, len(at))
            counts = np.full((len(at), len(languages)), SMOOTHING)
            for lang, item, n in rows:
                counts[at[item], place[lang]] += n
            return at, np.log(counts / (sums + SMOOTHING * max(len(at), 1))).astype(np.float32)

        self.words, self.word_logs = table(words, np.array([totals.get(x, 0) for x in languages], float))
        self.grams, self.gram_logs = {}, {}
        for n in LENGTHS:
            own = [r for r in pieces if len(r[1]) == n]
            sums = np.array([gram_totals.get((x, n), 0) for x in languages], float)
            self.grams[n], self.gram_logs[n] = table(own, sums)

    def backoff(self, word: str) -> np.ndarray:
        return self.back_off_all([word])[0]

    def back_off_all(self, words: list[str]) -> np.ndarray:
        """Of each word the mean log share of its longest known n-grams; zeros where no letter is known."""
        out, open_ = np.zeros((len(words), len(self.languages)), np.float32), np.arange(len(words))
        for n in LENGTHS:
            own = [grams(words[i], n) for i in open_.tolist()]
            counts = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.fromiter(map(self.grams[n].get, chain.from_iterable(own), repeat(-1)), np.int64, counts.sum())
            owner, known = np.repeat(np.arange(len(own)), counts), flat >= 0
            owner, flat = owner[known], flat[known]
            if flat.size:
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                sums = np.add.reduceat(self.gram_logs[n][flat].astype(np.float64), first, axis=0)
                out[open_[owner[first]]] = sums / np.diff(first, append=len(owner))[:, None]
                open_ = np.delete(open_, owner[first])
        return out


def train(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", words: int = MODEL_WORDS, pieces: int = MODEL_GRAMS
) -> Model:
    """A model of all texts of ``docs`` with a language; null texts and null languages say nothing."""
    counts = store(count_words(docs, lang=lang, text=text), "word_counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    gram_counts = store(count_grams(counts).withColumn("k", F.length("item")), "gram_counts")
    by_length = gram_counts.groupBy("lang", "k").agg(F.sum("n").alias("n")).collect()
    rows = lambda df, n, by: [tuple(r) for r in most_frequent(df, n, by).select("lang", "item", "n").collect()]
    return Model(
        sorted(totals),
        totals,
        rows(counts, words, ["lang"]),
        rows(gram_counts, pieces, ["lang", "k"]),
        {(r["lang"], r["k"]): r["n"] for r in by_length},
    )


class Identifier:
    """Predicts with a model; the scores of a distinct word are looked up once while remembered."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.rows, self.held = np.zeros((1 << 12, len(self.model.languages)), np.float32), 0

    def _learn(self, words: set[str]) -> None:
        """Scores of words that are new: known ones from their row, the others backed off all together."""
        model, memo = self.model, self.memo
        known = [w for w in words if w in model.words]
        other = [w for w in words if w not in model.words]
        first, last = len(memo), len(memo) + len(words)
        if last > len(self.rows):
            grown = np.zeros((1 << (last - 1).bit_length(), self.rows.shape[1]), np.float32)
            grown[:first] = self.rows[:first]
            self.rows = grown
        self.rows[first:first + len(known)] = model.word_logs[[model.words[w] for w in known]]
        self.rows[first + len(known):last] = model.back_off_all(other)
        memo.update(zip(chain(known, other), range(first, last)))
        self.held += sum(map(len, words))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for i in range(0, len(texts), SLICE):
            out += self._predict(texts[i:i + SLICE])
        return out

    def _predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        names, out = self.model.languages, []
        if len(self.memo) > WORKER_CACHE or self.held > MEMO_CHARACTERS:
            self._forget()
        split = [words_of(t) for t in texts]
        if names:
            self._learn(set().union(*split).difference(self.memo))
        for text, words in zip(texts, split):
            if not words or not names or not any(c.isalpha() for c in text):
                out.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
            total = self.rows[at].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            out.append((names[best], float(1 / np.exp(total - total[best]).sum())))
        return out


_IDENTIFIERS: dict[str, Identifier] = {}  # the last one of this process, by the name of its model


def identifier(name: str, model: Callable[[], Model]) -> Identifier:
    if name not in _IDENTIFIERS:
        _IDENTIFIERS.clear()
        _IDENTIFIERS[name] = Identifier(model())
    return _IDENTIFIERS[name]


def identify(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (its share of the posterior) per row. Null texts and texts without a
    letter are "und" with score 0, and so is everything where nothing was learned; ties go to the first
    language by name. Null and repeated ids stay as they are; other columns are not read; an empty table
    gives an empty one."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = identifier(name, lambda: shared.value)
        for batch in batches:
            found = reader.predict(batch.column(1).to_pylist())
            names, scores = [x[0] for x in found], [x[1] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
