"""Toxicity of whole texts: noisy-channel restoration of disguised words, then a linear score of the restored words.

1. A character language model: counts of letter trigrams over all documents, gathered in Spark, on 28 symbols.
2. Disguised spots (digits and signs for letters, spaced-out letters, stretched letters) become lattices: each character may
   stand for some letters, a separator for nothing or a word end, a repeated letter for nothing. Viterbi decoding takes the
   path with the best sum of channel and trigram log-probabilities.
3. Words of the text and of the restored spots, and their beginnings, are features. Their weights are log-odds from labelled
   documents, shrunk by their standard error; three sums of them go through a logistic curve.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walrill.llm.common import frugal, materialise, raw_texts, slices

#: At most so many labelled rows train the classifier: those with the least hashes of their ids.
TRAIN_ROWS = 40_000
#: Beginnings of words that are features, in letters.
PREFIXES = (3, 4, 5, 6, 7)

#: Symbols of the language model: 0 for a word's edge, 1 to 26 for a to z, 27 for any other letter.
SYMBOLS = 28

#: What a sign may stand for (fixed values).
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h",
}
#: Signs that may stand between the letters of one word (fixed values).
SEPARATORS = " .-_*~·/\\"
#: Log-probabilities of the channel (fixed values).
SAME, OTHER, DROP_REPEAT, KEEP_REPEAT, DROP_SEPARATOR, BREAK = -0.05, -0.7, -0.3, -0.5, -0.2, -1.5

_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(STANDS_FOR))
#: Spots that may be disguised: letters mixed with signs, single letters in a row, a letter three times or more.
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_]|[@$!|+€£])(?:[ .\-_*~·/\\](?:[^\W_]|[@$!|+€£])(?![^\W_])){2,}")
_RUN = re.compile(rf"(?:[^\W_]|[{_SIGNS}])+")
#: So many signs or digits in a row stand for no letters: what is on either side of them are spots of their own.
_NUMBER = re.compile(rf"[{_SIGNS}]{{17,}}")
#: What makes a run of letters and signs a spot: signs inside, at its beginning, or digits and the like at its end.
_INSIDE = re.compile(rf"[^\W\d_][{_SIGNS}]+[^\W\d_]")
_AHEAD = re.compile(rf"[{_SIGNS}]+[^\W\d_]{{2}}")
_BEHIND = re.compile(r"[^\W\d_]{2}[\d@$]+(?![^\W_])")
#: Signs that are cut off a spot's beginning unless they stand for letters there, and those that are cut off its end.
_LOOSE_AHEAD = "".join(c for c in STANDS_FOR if not c.isdigit())
_LOOSE_BEHIND = _LOOSE_AHEAD.replace("@", "").replace("$", "")
_TRIPLE = re.compile(r"(.)\1\1")
_SAME_RUN = re.compile(r"(.)\1*", re.DOTALL)
#: What may stand around a word (fixed values).
_QUOTES = ".,;:!?\"'()"


# --- language model ---------------------------------------------------------------------------------------------


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for i in range(26):
        table[97 + i] = table[65 + i] = i + 1
    table[128:] = 27
    return table


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _symbol_table()
    total = np.zeros(SYMBOLS**3, np.int64)
    for b in batches:
        texts = raw_texts(b.column(0))
        for a, z in slices(texts):
            s = table[np.frombuffer(b"  " + b"  ".join(t or b"" for t in texts[a:z]) + b"  ", np.uint8)]
            s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))]
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    full = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], names=["gram", "n"])


def language_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of the third symbol after two others, from all of ``docs``: a table of 28**3 numbers.

    Every task sends its counts, at most as many rows as the table has; Witten-Bell weights join the orders 3 to 0."""
    counts = np.zeros(SYMBOLS**3)
    for r in docs.select(text).mapInArrow(frugal(_trigrams), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r["gram"]] = r["n"]
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + SYMBOLS)
    for c in (two, three):
        kinds, n = (c > 0).sum(axis=-1, keepdims=True), c.sum(axis=-1, keepdims=True)
        p = np.where(n > 0, (c + kinds * p) / np.maximum(n + kinds, 1), p)
    return np.log(p)


# --- channel ----------------------------------------------------------------------------------------------------


def _edges(c: str) -> list[tuple[str, float]]:
    """What a character may stand for, with log-probabilities."""
    if c in SEPARATORS and c != "*":
        return [("", DROP_SEPARATOR), (" ", BREAK)]
    if "a" <= c <= "z":
        return [(c, SAME)]
    if c in STANDS_FOR:
        return [(x, OTHER) for x in STANDS_FOR[c]]
    return [(c, SAME)] if c.isalpha() else [("", DROP_SEPARATOR), (" ", BREAK)]


def lattice(spot: str) -> list[list[tuple[str, float]]]:
    """For each character of a spot in lower case its edges; a repeated one of three or more may also stand for nothing."""
    out = []
    for m in _SAME_RUN.finditer(spot):
        edges, n = _edges(m[1]), len(m[0])
        out.append(edges)
        if n > 1:
            again = [*((x, p + KEEP_REPEAT) for x, p in edges), ("", DROP_REPEAT)] if n > 2 and m[1].isalnum() else edges
            out += [again] * (n - 1)
    return out


def _symbol(x: str) -> int:
    return 0 if x == " " else ord(x) - 96 if "a" <= x <= "z" else 27


def restore(spot: str, model: np.ndarray) -> str:
    """The likeliest words behind a disguised spot, lower case, by Viterbi over the last two letters of the path.

    Paths are chains from their ends, so time grows with the length of the spot and no more."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    item = model.item
    for edges in lattice(spot.lower()):
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for key, (score, path) in states.items():
            u, v = key
            for x, p in edges:
                if not x:
                    at, total, longer = key, score + p, path
                else:
                    s = _symbol(x)
                    if s == 0 and v == 0:
                        continue
                    at, total, longer = (v, s), score + p + item(u, v, s), (x, path)
                if at not in new or total > new[at][0]:
                    new[at] = (total, longer)
        states = new or states
    path, out = max(((score + (item(u, v, 0) if v else 0.0), u, v, path) for (u, v), (score, path) in states.items()), key=lambda s: s[:3])[3], []
    while path:
        x, path = path
        out.append(x)
    return "".join(reversed(out))


def spots(token: str) -> list[str]:
    """The parts of a lower-case token that may be disguised: letters mixed with signs, and words with a letter three times in a row."""
    found = []
    for run in _RUN.findall(token):
        for part in _NUMBER.split(run) if len(run) > 16 else (run,):
            if _AHEAD.match(part):
                found.append(part.rstrip(_LOOSE_BEHIND))
            elif _INSIDE.search(part) or _BEHIND.search(part):
                found.append(part.lstrip(_LOOSE_AHEAD).rstrip(_LOOSE_BEHIND))
    return found + [w for w in _WORD.findall(token) if _TRIPLE.search(w)]


class Restorer:
    """Words of a text, those of its disguised spots restored; remembers the tokens that it has met."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def _decoded(self, spot: str) -> list[str]:
        words = _WORD.findall(restore(spot, self.model))
        return [*words, "".join(words)] if len(words) > 1 else words

    def _of_token(self, token: str) -> tuple[str, ...]:
        bare = token.strip(_QUOTES)
        found = [bare] if bare.isalpha() else _WORD.findall(token)
        for spot in spots(token):
            found += self._decoded(spot)
        return tuple(dict.fromkeys(found))

    def of(self, token: str) -> tuple[str, ...]:
        """The words of a lower-case run of characters without white space."""
        words = self.known.get(token)
        if words is None:
            words = self._of_token(token)
            if len(token) <= 64:
                if len(self.known) > 150_000:
                    self.known.clear()
                self.known[token] = words
        return words

    def spaced(self, low: str) -> list[str]:
        """The words behind spaced-out letters."""
        return [w for spot in {m[0] for m in _SPACED.finditer(low)} for w in self._decoded(spot)]

    def words(self, text: str) -> set[str]:
        low = text.lower()
        return set(chain.from_iterable(map(self.of, set(low.split())))).union(self.spaced(low))


# --- features and weights ---------------------------------------------------------------------------------------


def features(word: str) -> list[str]:
    """The word itself and its beginnings, the most specific first."""
    return [f"{word}$", *(word[:k] for k in reversed(PREFIXES) if len(word) > k)]


def _decode(texts: list[bytes | None]) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in texts]


def _word_counts(model: np.ndarray):
    """Of (text, toxic, fold): for each word in how many texts of each class and fold it occurs."""
    names = ["word", "n0", "n1", "n2", "n3"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for b in batches:
            kinds = [2 * f + y for y, f in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            counts = [Counter() for _ in range(4)]
            for text, kind in zip(_decode(raw_texts(b.column(0))), kinds, strict=True):
                counts[kind].update(restorer.words(text))
            keys = list(set().union(*counts))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)], names=names)

    return run


class Weights:
    """Weights of words: a word's own if it has one, else the greatest of its beginnings'; tokens without any are remembered."""

    def __init__(self, table: dict[str, float], restorer: Restorer):
        self.table, self.restorer, self.known = table, restorer, {}
        #: First letters that any feature has; nearly all words end here.
        self.heads = {f.rstrip("$")[:3] for f in table}

    def of(self, word: str) -> float:
        if word[:3] not in self.heads:
            return 0.0
        get = self.table.get
        return max([0.0, *(get(f, 0.0) for f in features(word))])

    def _of_token(self, token: str) -> dict[str, float]:
        bare = token.strip(_QUOTES)
        if bare.isalpha() and not _TRIPLE.search(bare):
            found = {bare: w} if (w := self.of(bare)) > 0 else None
        else:
            found = {x: w for x in self.restorer.of(token) if (w := self.of(x)) > 0} or None
        if len(token) <= 64:
            if len(self.known) > 250_000:
                self.known.clear()
            self.known[token] = found
        return found

    def evidence(self, text: str) -> tuple[float, float, float]:
        """Sum of the weights of a text's words (damped for long texts), the greatest of them, and how many there are."""
        low = text.lower()
        tokens, known, found = set(low.split()), self.known, {}
        for t in tokens:
            if (w := known[t] if t in known else self._of_token(t)) is not None:
                found.update(w)
        found.update({x: w for x in self.restorer.spaced(low) if (w := self.of(x)) > 0})
        return (sum(sorted(found.values())) / math.sqrt(1 + len(tokens) / 200), max(found.values(), default=0.0), math.log1p(len(found)))


def _evidence(model: np.ndarray, tables: list[dict[str, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        weights = [Weights(t, restorer) for t in tables]
        for b in batches:
            folds = b.column(2).to_pylist()
            rows = [weights[1 - f].evidence(t) for t, f in zip(_decode(raw_texts(b.column(0))), folds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array([r[k] for r in rows], pa.float64()) for k in range(3))], names=["toxic", "x0", "x1", "x2"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of [1, x] by Newton's method with a ridge on all but the constant."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    """Everything that scoring needs; of bounded size."""

    def __init__(self, trigrams: np.ndarray, table: dict[str, float], curve: np.ndarray):
        self.trigrams, self.table, self.curve = trigrams, table, curve

    def scores(self, weights: Weights, texts: list[str]) -> np.ndarray:
        x = np.array([weights.evidence(t) for t in texts]).reshape(len(texts), 3)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ self.curve[1:], -30, 30)))


def log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """How much likelier a text with the feature is to be toxic, less one standard error."""
    a, b = toxic + 0.5, clean + 0.5
    return math.log(a / (n_toxic + 1)) - math.log(b / (n_clean + 1)) - math.sqrt(1 / a + 1 / b) if toxic >= 2 else 0.0


def fold_of(row_id):
    """crc32(id as text) mod 5; rows with 0 are held out and never give a label. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model from the labels (doc_id, toxic) of rows that are not held out; the language model sees all of ``docs``.

    Of labelled rows at most ``train_rows`` are taken, by the hash of the id. Rows with contradicting labels or a null label
    are left out, and so are equal texts with contradicting labels; other equal texts count once. Without a toxic and a clean text among them every score is the constant 0."""
    trigrams = language_model(docs)
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    chosen = known.where(fold_of("doc_id") != 0).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary"))).limit(train_rows).select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    # At most train_rows rows of two numbers are broadcast.
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "toxic", F.xxhash64("text").alias("h"))
    rows = rows.groupBy("h").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    rows = materialise(rows.select("text", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("fold")))
    sizes = {(r["toxic"], r["fold"]): r["n"] for r in rows.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = {y: [sizes.get((y, f), 0) for f in (0, 1)] for y in (0, 1)}
    if not sum(n[0]) or not sum(n[1]):
        return Model(trigrams, {}, np.array([-30.0, 0, 0, 0]))
    counts = rows.mapInArrow(frugal(_word_counts(trigrams)), "word string, n0 long, n1 long, n2 long, n3 long")
    four = [f"n{k}" for k in range(4)]
    counts = materialise(counts.groupBy("word").agg(*(F.sum(k).alias(k) for k in four)))
    toxic, clean = F.col("n1") + F.col("n3"), F.col("n0") + F.col("n2")
    telling = (toxic >= 3) & (toxic * float(sum(n[0])) > 8.0 * clean * float(sum(n[1])))
    # A beginning speaks for words unlike those that speak for themselves, and only if several share it.
    starts = F.explode(F.array(*(F.when(F.length("word") > k, F.substring("word", 1, k)) for k in PREFIXES)))
    stems = counts.where(~telling).select(starts.alias("feature"), *four, (toxic > 0).cast("int").alias("kinds"))
    stems = stems.where("feature is not null").groupBy("feature").agg(*(F.sum(k).alias(k) for k in four), F.sum("kinds").alias("kinds")).where("kinds >= 3").drop("kinds")
    both = counts.where(telling).select(F.concat("word", F.lit("$")).alias("feature"), *four).unionByName(stems.where(telling))
    # Words of three toxic training texts or more that are rare in clean ones: what train_rows rows can give, whatever the corpus.
    tables: list[dict[str, float]] = [{}, {}, {}]
    for r in both.collect():
        for k, table in enumerate(tables):
            folds = (0, 1) if k == 2 else (k,)
            w = log_odds(sum(r[f"n{2 * f + 1}"] for f in folds), sum(r[f"n{2 * f}"] for f in folds), sum(n[1][f] for f in folds), sum(n[0][f] for f in folds))
            if w > 0.5:
                table[r["feature"]] = w
    # Each fold's evidence comes from the other fold's weights: three numbers for each of at most train_rows rows.
    seen = rows.mapInArrow(frugal(_evidence(trigrams, tables[:2])), "toxic int, x0 double, x1 double, x2 double").toPandas()
    curve = fit_logistic(seen[["x0", "x1", "x2"]].to_numpy(), seen["toxic"].to_numpy())
    return Model(trigrams, tables[2], curve)


def _scorer(model: Model, text_of, fields: list[str], keep: int):
    """Appends scores of the texts that ``text_of`` finds in a batch to its first ``keep`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model.table, Restorer(model.trigrams))
        for b in batches:
            texts, scores = raw_texts(text_of(b)), []
            for a, z in slices(texts):
                scores.append(model.scores(weights, _decode(texts[a:z])))
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=fields)

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs`` (doc_id, text); null and empty texts have a score too.

    Equal texts have equal scores; rows with null or repeated ids count each for itself."""
    model = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of("doc_id") == 0).alias("held_out"), "text")
    scored = rows.mapInArrow(frugal(_scorer(model, lambda b: b.column(2), ["doc_id", "held_out", "score"], 2)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns."""
    model = train(docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).alias("text")), labels)
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    at = docs.columns.index(text)
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(frugal(_scorer(model, lambda b: b.column(0).field(at), ["row", "score"], 1)), schema).where(F.col("score") < limit).select("row.*")
