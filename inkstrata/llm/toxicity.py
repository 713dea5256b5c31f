"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features come from whole texts in Arrow batches; trees and calibration are fitted by
Spark on separate parts of the labelled training rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.llm.common import hold, schema_with, slices, texts_of
from inkstrata.session import materialize

FOLDS = 5
# Labelled rows to fit on: all up to this number, beyond it a hash sample of about as many.
MAX_ROWS = 20_000
# Words and beginnings of words learned from the labels: texts that have them, share of
# toxic ones among these, how many.
LEARNED_ROWS, LEARNED_SHARE, LEARNED_WORDS = 6, 0.85, 400
PREFIXES = (4, 5, 6)
NEAR = 5
# Documents with this score and more are toxic.
THRESHOLD = 0.5

# Common insults.
LEXICON = frozenset(
    """
    idiot moron stupid dumb loser scum trash garbage clown pathetic worthless disgusting ugly fool jerk bastard bitch
    asshole crap damn shit fuck fucking fucker whore slut retard retarded imbecile cretin creep freak vermin filth filthy
    hate kill die idioten dumm dummkopf arschloch scheisse schwein abschaum idiota estupido imbecil basura cabron puta
    mierda asqueroso connard salaud merde ordure stupide salope encule
    """.split()
)
# Forms of address.
SECOND_PERSON = frozenset("you your yours yourself u ur ya du dich dir dein deine ihr euch tu te toi ton ta vous votre usted ustedes ti tus".split())
# Signs put for letters.
_LEET = str.maketrans("013457@$!|", "oieastasii")

_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”‘’«»¡¿"
# Signs around a word that stand for no letter; some may begin a word, fewer end one.
_BEFORE = "".join(c for c in _EDGE if c not in "@$!|*")
_BEHIND = "".join(c for c in _EDGE if c not in "@$|*")
_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_RUN = re.compile(r"([^\W\d_])\1\1")

FEATURES = [
    "lexicon_density",
    "lexicon_hits",
    "learned_density",
    "learned_hits",
    "second_person_density",
    "second_person_near",
    "capital_rate",
    "capital_words",
    "exclamation_rate",
    "punctuation_rate",
    "obfuscated_rate",
    "obfuscated_hits",
    "letter_runs",
    "log_words",
]


def words_of(text: str) -> list[str]:
    """Words parted by white space, without signs around them, in lower case."""
    return [word.strip(_EDGE).lower() for word in text.split()]


class Learned:
    """Words, and beginnings of words, that mark toxic texts."""

    def __init__(self, words: Iterable[str] = (), prefixes: Iterable[str] = ()):
        self.words, self.prefixes = frozenset(words), frozenset(prefixes)
        self.sizes = sorted({len(p) for p in self.prefixes})

    def __contains__(self, word: str) -> bool:
        return word in self.words or any(word[:size] in self.prefixes for size in self.sizes)


_BY_SIZE: dict[int, list[str]] = {}
for _word in sorted(LEXICON):
    _BY_SIZE.setdefault(len(_word), []).append(_word)


def unmasked(raw: str, learned: Learned) -> tuple[bool, bool]:
    """Whether signs or digits stand for letters of a word, and whether these make a known word.

    Signs that may be letters count at both ends of the word; a star is any letter of a
    listed insult. Stars at both ends are emphasis.
    """
    word = raw.lstrip(_BEFORE).rstrip(_BEHIND).lower()
    if word[:1] == "*" == word[-1:]:
        word = word.strip("*")
    if word.isalpha() or not any(map(str.isalpha, word)):
        return False, False
    plain = word.translate(_LEET)
    if "*" in plain:
        return True, any(all(a in (b, "*") for a, b in zip(plain, known)) for known in _BY_SIZE.get(len(plain), ()))
    return plain != word, plain != word and (plain in LEXICON or plain in learned)


def features_of(text: str, learned: Learned) -> list[float]:
    """``FEATURES`` of a text; a text without words has zeros."""
    raw = text.split()
    if not raw:
        return [0.0] * len(FEATURES)
    words = [word.strip(_EDGE).lower() for word in raw]
    count = len(words)
    marked = {word for word in set(words) if word in learned}
    hits = [at for at, word in enumerate(words) if word in LEXICON or word in marked]
    known = sum(words[at] in LEXICON for at in hits)
    taught = sum(words[at] in marked for at in hits)
    people = [at for at, word in enumerate(words) if word in SECOND_PERSON]
    near = 0
    if hits and people:
        places = set(people)
        near = sum(any(p in places for p in range(at - NEAR, at + NEAR + 1)) for at in hits)
    masked = mended = 0
    for word in raw:
        if not word.isalpha():
            signs_for_letters, known_word = unmasked(word, learned)
            masked += signs_for_letters
            mended += known_word
    data = text.encode("utf-8", "surrogatepass")
    letters = len(data) - len(data.translate(None, _LETTERS))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    signs = len(data) - len(data.translate(None, _SIGNS))
    shouted = sum(map(str.isupper, raw))
    return [
        100.0 * known / count,
        math.log1p(known),
        100.0 * taught / count,
        math.log1p(taught),
        100.0 * len(people) / count,
        float(near),
        capitals / max(letters, 1),
        shouted / count,
        100.0 * data.count(b"!") / len(data),
        100.0 * signs / len(data),
        100.0 * masked / count,
        math.log1p(mended),
        100.0 * sum(1 for _ in _RUN.finditer(text)) / count,
        math.log(count),
    ]


_INNER = [f"_toxicity_{name}" for name in FEATURES]


def _featurize(at: int, learned: Learned) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity")
        for batch in slices(batches):
            made = zip(*(features_of(t, learned) for t in texts_of(batch.column(at))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(column, pa.float64()) for column in made)], names=[*batch.schema.names, *_INNER])

    return run


def features(docs: DataFrame, learned: Learned, text: str = "text") -> DataFrame:
    """``docs`` with one column ``_toxicity_name`` for each feature of ``FEATURES``."""
    schema = schema_with(docs, docs.columns, ", ".join(f"{name} double" for name in _INNER))
    return docs.mapInArrow(_featurize(docs.columns.index(text), learned), schema)


def fold(doc_id: Column) -> Column:
    """0 to ``FOLDS - 1`` from the crc32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_labels(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, label, part`` of the rows to fit on, none of the held-out fold.

    One row for each id (any toxic label counts); rows without an id or a label are
    left out. ``part`` 0 is for calibration, 1 to 3 for the trees.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
    own = own.groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
    count = own.count()
    share = min(1.0, max_rows / max(count, 1))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(round(share * 1_000_000))
    return own.where(drawn).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(4)))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and beginnings of words with the number of texts and of toxic texts that have them."""
    for batch in slices(batches):
        counts: Counter[tuple[str, bool, float]] = Counter()
        for label, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            own = set(words_of(text))
            counts.update((word, False, label) for word in own)
            counts.update((begin, True, label) for begin in {w[:size] for w in own for size in PREFIXES if len(w) >= size})
        keys, numbers = list(counts), list(counts.values())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.bool_()),
                pa.array(numbers, pa.int64()),
                pa.array([int(k[2]) * n for k, n in zip(keys, numbers)], pa.int64()),
            ],
            names=["unit", "begins", "n", "toxic"],
        )


def learn_words(rows: DataFrame) -> Learned:
    """Units that mark toxic training texts (``label, text``): at most ``LEARNED_WORDS``, the most frequent first.

    Equal texts count once.
    """
    rows = rows.withColumn("_same", F.xxhash64("text")).dropDuplicates(["_same"])
    counts = rows.select("label", "text").mapInArrow(_units, "unit string, begins boolean, n bigint, toxic bigint").groupBy("unit", "begins")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    chosen = counts.where((F.col("n") >= LEARNED_ROWS) & (F.col("toxic") >= LEARNED_SHARE * F.col("n")) & (F.length("unit") > 2))
    found = chosen.orderBy(F.desc("toxic"), "unit").limit(LEARNED_WORDS).collect()
    return Learned((r["unit"] for r in found if not r["begins"]), (r["unit"] for r in found if r["begins"]))


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=_INNER, outputCol="_toxicity_features").transform(df)


def _margin(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    return model.transform(_assembled(df)).withColumn("_toxicity_margin", vector_to_array("_toxicity_raw")[1])


Models = tuple[GBTClassificationModel, IsotonicRegressionModel]


def fit(rows: DataFrame) -> Models | None:
    """Trees and calibration from featured rows with ``label`` and ``part``.

    None where the labels are too few to have both kinds in both parts.
    """
    kinds = {tuple(r) for r in rows.select(F.col("part") > 0, "label").distinct().collect()}
    if len(kinds) < 4:
        return None
    booster = GBTClassifier(featuresCol="_toxicity_features", labelCol="label", predictionCol="_toxicity_tree", maxIter=20, maxDepth=3, stepSize=0.3, seed=8)
    booster = booster.setProbabilityCol("_toxicity_prob").setRawPredictionCol("_toxicity_raw")
    trees = booster.fit(_assembled(rows.where("part > 0")))
    margins = _margin(trees, rows.where("part = 0")).select("_toxicity_margin", "label")
    isotonic = IsotonicRegression(featuresCol="_toxicity_margin", labelCol="label", predictionCol="_toxicity_score").fit(margins)
    return trees, isotonic


def _scores(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``docs`` with its columns renamed to ``c0, c1, ...``, and ``score``."""
    training = materialize(training_labels(labels, max_rows), "labels")
    # bounded by max_rows: of rows that repeat an id, the least text
    rows = docs.select("doc_id", "text").join(F.broadcast(training), "doc_id")
    rows = materialize(rows.groupBy("doc_id", "label", "part").agg(F.min("text").alias("text")), "training-texts")
    learned = learn_words(rows.where("part > 0"))
    models = fit(materialize(features(rows, learned).drop("text"), "training"))
    plain = [f"c{i}" for i in range(len(docs.columns))]
    text = plain[docs.columns.index("text")]
    docs = docs.toDF(*plain)
    if models is None:
        share = training.agg(F.avg("label")).first()[0] or 0.0
        return docs.withColumn("score", F.lit(float(share)))
    trees, isotonic = models
    found = isotonic.transform(_margin(trees, features(docs, learned, text)))
    return found.select(*plain, F.least(F.greatest(F.col("_toxicity_score"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def scored(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, score: str = "toxicity_score") -> DataFrame:
    """``docs`` with the column ``score``, a probability.

    ``labels`` (``doc_id, toxic``) are used of the rows outside the held-out fold only.
    A null or empty text is scored by its zero features. Too few labels for a model
    give every row the share of toxic labels, 0 without any. Other columns may have any
    names; one named as the new one is an error.
    """
    if score.lower() in map(str.lower, docs.columns):
        raise ValueError(f"the table has a column {score}; give the score another name")
    return _scores(docs, labels, max_rows).toDF(*docs.columns, score)


def report(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row; a null id is never held out."""
    value = F.col("score")
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    found = scored(docs.select("doc_id", "text"), labels, max_rows, "score")
    return found.select("doc_id", held_out.alias("held_out"), value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` with a score below ``THRESHOLD``, with the columns of ``docs``."""
    return _scores(docs, labels, max_rows).where(F.col("score") < THRESHOLD).drop("score").toDF(*docs.columns)
