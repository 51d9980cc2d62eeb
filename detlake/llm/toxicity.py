"""Toxicity: a weighted lexicon matched by Aho-Corasick in text and lexicon folded to one skeleton of look-alike letters,
normalised by length, with exception phrases.

A base lexicon of insults is the floor; the rest is learnt: a word's weight is its log odds between toxic and other texts of a
bounded sample of labelled rows. A word is learnt when its log likelihood ratio against the rate of all words is beyond the
logarithm of the number of stems compared, so whatever the number of labels about one stem gets in by chance. The weight of
a base word moves from its given one to its log odds as occurrences come in, and the word goes where these speak against it.
Occurrences count by their distinct pairs of neighbours, so copies of one text do not make its words toxic. Phrases of two
words with a lexicon word that belong to other texts become exceptions, beside given ones. A text's score is a logistic
function of its summed weights, of that sum for a hundred words, and of whether there is any match.

Learnt entries are beginnings of words, so inflected and compound words count; base entries take the endings of inflected
words and no others. A match begins where a word begins. White space of any length is one blank. The sample is the only bound:
stems and exceptions that pass the test all count.

Defined cases: null and empty texts have no match; without labelled rows the base lexicon stands alone and
the calibration is `PRIOR`;
repeated rows score alike; other columns are ignored; long texts count whole."""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from detlake.llm.sampling import TRAINING_ROWS, crc_of, training_rows
from detlake.session import durable

#: letters of a stem; of longer words the first `LONGEST` letters are their stems
SHORTEST, LONGEST = 3, 24
#: insults in four languages as stems, with weights: 3 for words that have other uses, 4 for mild and 5 for strong ones. A word
#: of the base lexicon is a stem and one of `ENDINGS`
BASE = {
    **dict.fromkeys("clown creep dumb filth filthi garbage loser pathetic pervert ridicul trash abschaum widerlich dégoût escoria".split(), 3.0),
    **dict.fromkeys("coward cretin crétin degenerate disgusting fool idiot imbecil imbécil lunatic moron scum scumbag stupid worthless dumm dummkopf blödmann trottel versager débile minable estúpid inútil".split(), 4.0),
    **dict.fromkeys("asshole dumbass bastard bitch bullshit cunt dickhead dipshit douchebag fuck motherfuck shithead slut whore wanker arschloch arschlöch hurensohn hurensöhn missgeburt schlampe wichser connard connasse enculé salope cabrón gilipollas pendej".split(), 5.0),
}
#: occurrences that weigh as much as the given weight of a base word
BASE_EVIDENCE = 8
#: base words that fall below this weight go
LEAST_BASE = 1.0
#: calibration without labels, which labels move away from
PRIOR = (-4.0, 1.0, 1.0, 1.0)
LEAST_WEIGHT = 3.0
HEAVIEST = 6.0
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser", "garbage can", "garbage collect", "dumb bell", "april fool", "dumb waiter")

# fixed values: characters that stand for a Latin letter (digits and signs, Cyrillic, Greek); letters that look alike share one
CLASSES = {"l": "i"}
DIGITS = {"0": "o", "1": "i", "!": "i", "|": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
#: a sign with a second reading
SECOND = {"6": "b"}
LOOKALIKES = {"а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d",
              "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "г": "r", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
              "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ո": "n", "ѵ": "v"}
#: characters that are not seen, and diacritics
HIDDEN = {c: None for c in (0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x0300, 0x0370), *range(0x1AB0, 0x1B00), *range(0x1DC0, 0x1E00), *range(0x20D0, 0x2100), *range(0xFE20, 0xFE30))}
SKELETON = str.maketrans({c: CLASSES.get(x, x) for c, x in {**CLASSES, **DIGITS, **LOOKALIKES}.items()})
OTHER = SKELETON | str.maketrans(SECOND)
WORD = re.compile(r"[^\W_](?:[^\s,.;:!?|()\"#%&*]*[^\W_])?")


def lowered(text: str) -> str:
    """Lower case, decomposed, without diacritics and hidden characters, white space as one blank; places in a skeleton are
    places in it."""
    return " ".join((text.lower() if text.isascii() else unicodedata.normalize("NFKD", text.lower()).lower().translate(HIDDEN)).split())


def skeleton(text: str) -> str:
    return lowered(text).translate(SKELETON)


#: endings of inflected words in these languages, beside none
ENDINGS = frozenset(map(skeleton, ["", *"s es ed d er ers r rs ing ings in innen en em e n st ste sten te ten est ish ishly ic ical ically ly ity ities ism ous ously ness a as o os ez is iss ie ies".split()]))


def folded_words(text: str) -> list[str]:
    return [w.translate(SKELETON) for w in WORD.findall(lowered(text).replace("_", " "))] if text else []


class Matcher:
    """Finds lexicon words in a text; pickles as its word list. Entries in `inflected` end where a word with an ending of
    `ENDINGS` ends, others anywhere in a word."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...], inflected: frozenset[str] = frozenset()):
        self.lexicon, self.exceptions, self.inflected, self._auto = lexicon, exceptions, inflected, None

    def __getstate__(self):
        return {**self.__dict__, "_auto": None}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def _build(self):
        import ahocorasick

        self._auto = ahocorasick.Automaton()
        weights: dict[str, tuple[float, bool]] = {}
        for word, weight in self.lexicon.items():
            key = skeleton(word)
            weights[key] = max(weights.get(key, (weight, False)), (weight, word in self.inflected))
        for word, (weight, ends) in weights.items():
            self._auto.add_word(word, (len(word), weight, ends))
        for phrase in map(skeleton, self.exceptions):
            self._auto.add_word(phrase, (len(phrase), None, False))
        if len(self._auto):
            self._auto.make_automaton()

    def weight(self, text: str) -> tuple[float, int]:
        """(sum of the weights of matches outside exceptions, the heaviest where several begin; number of words)"""
        if self._auto is None:
            self._build()
        low = lowered(text)
        words = low.count(" ") + 1
        if not len(self._auto):
            return 0.0, words
        found, spared = {}, []
        for form in (low.translate(SKELETON), *([low.translate(OTHER)] if "6" in low else [])):
            for end, (size, weight, ends) in self._auto.iter(form):
                start = end - size + 1
                if start and low[start - 1].isalnum():
                    continue
                if weight is None:
                    spared.append((start, end))
                elif not ends or _ending(low, form, end + 1) in ENDINGS:
                    found[start] = max((weight, end), found.get(start, (weight, end)))
        if not found:
            return 0.0, words
        return sum(w for a, (w, b) in found.items() if not any(x <= a and b <= y for x, y in spared)), words


def _ending(low: str, form: str, at: int) -> str:
    """The letters of the skeleton from a place to the end of the word."""
    end = at
    while end < len(low) and low[end].isalpha():
        end += 1
    return form[at:end]


def _signals(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weight)), (weight > 0).astype(float), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], 1)


def minimal_stems(stems: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Weights of the stems that stand for a family of words: a stem that loses nothing by being longer is spelt out, and
    one that a shorter stem covers goes."""
    spelt = {}
    for stem, (a, b, w) in sorted(stems.items(), key=lambda x: len(x[0])):
        short = next((s for s in spelt if stem.startswith(s)), None)
        if short is None:
            spelt[stem] = (a, w, stem)
        elif a >= 0.9 * spelt[short][0]:
            spelt[short] = (*spelt[short][:2], max(spelt[short][2], stem, key=len))
    return {full: min(w, HEAVIEST) for _, w, full in spelt.values()}


def with_base(learnt: dict[str, float], seen: dict[str, tuple[int, float]], base: dict[str, float]) -> dict[str, float]:
    """Learnt stems, and base stems that begin with none of them. `seen`: (occurrences, log odds) of base stems."""
    lexicon = {}
    for stem, given in base.items():
        n, odds = seen.get(stem, (0, 0.0))
        weight = (BASE_EVIDENCE * given + n * odds) / (BASE_EVIDENCE + n)
        if weight >= LEAST_BASE:
            lexicon[stem] = min(weight, HEAVIEST)
    for stem, weight in learnt.items():
        for longer in [s for s in lexicon if s.startswith(stem)]:
            weight = max(weight, lexicon.pop(longer))
        lexicon[stem] = weight
    return lexicon


def learn_lexicon(rows: DataFrame) -> tuple[dict[str, float], tuple[str, ...]]:
    """(weight of each lexicon word, exception phrases) from a bounded sample (id, label, text)."""

    def neighbours(batches):
        for batch in batches:
            label, word, left, right = [], [], [], []
            for y, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                words = ["", *folded_words(text), ""]
                seen = {(words[i], words[i - 1], words[i + 1]) for i in range(1, len(words) - 1)}
                for w, a, b in seen:
                    label.append(y)
                    word.append(w)
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), *(pa.array(x, pa.string()) for x in (word, left, right))], names=["label", "word", "before", "behind"])

    near = rows.mapInArrow(neighbours, "label int, word string, before string, behind string")
    # one row for each word and surrounding, toxic if any text with it is not clean
    places = near.groupBy("word", "before", "behind").agg(F.max("label").alias("bad"), F.min("label").alias("good"))
    counts = durable(places.groupBy("word").agg(F.sum("bad").alias("a"), F.sum(1 - F.col("good")).alias("b")))
    totals = counts.agg(F.sum("a"), F.sum("b")).first()
    bad, good = (totals[0] or 0) + 1.0, (totals[1] or 0) + 1.0
    odds = F.log((F.col("a") + 0.5) / bad) - F.log((F.col("b") + 0.5) / good)
    # stems: the beginnings of words, over distinct words and their places
    starts = F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST))), lambda n: F.substring("word", F.lit(1), n))
    stems = durable(counts.where(F.length("word") >= SHORTEST).withColumn("stem", F.explode(starts)).groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    # likelihood of a stem's share of toxic places against that of all words; many stems are compared, and chance must not pass
    n, ratio = F.col("a") + F.col("b"), likelihood_ratio(bad / (bad + good))
    compared = max(stems.count(), 1)
    top = stems.where("a > 0").withColumn("w", odds).where((F.col("w") >= LEAST_WEIGHT) & (ratio >= math.log(compared))).collect()
    base = {skeleton(word): weight for word, weight in BASE.items()}
    seen = stems.where(F.col("stem").isin(list(base))).select("stem", n.alias("n"), odds.alias("w")).collect()
    lexicon = with_base(minimal_stems({r.stem: (r.a, r.b, float(r.w)) for r in top}), {r.stem: (r.n, float(r.w)) for r in seen}, base)
    found = F.array_intersect(F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda n: F.substring("word", F.lit(1), n)), F.array(*(F.lit(x) for x in lexicon)))
    held = places.where(F.size(found) > 0)
    pairs = held.select(F.concat_ws(" ", "word", "behind").alias("phrase"), "bad", "good", F.col("behind").alias("o")).unionByName(
        held.select(F.concat_ws(" ", "before", "word").alias("phrase"), "bad", "good", F.col("before").alias("o"))).where("o <> ''")
    phrases = durable(pairs.groupBy("phrase").agg(F.sum("bad").alias("a"), F.sum(1 - F.col("good")).alias("b")))
    a, b, compared = phrases.agg(F.sum("a"), F.sum("b"), F.count("*")).first()
    # as for stems, the other way round: phrases with lexicon words that stand in other texts beyond chance
    other = likelihood_ratio(((a or 0) + 1.0) / ((a or 0) + (b or 0) + 2.0))
    spared = phrases.where((F.col("b") > F.col("a")) & (other >= math.log(max(compared, 2)))).collect()
    return lexicon, tuple(r.phrase for r in spared)


def likelihood_ratio(share: float) -> Column:
    """Log likelihood ratio of `a` toxic places beside `b` others, against `share` of toxic places in all."""
    n = F.col("a") + F.col("b")
    return (F.when(F.col("a") > 0, F.col("a") * F.log(F.col("a") / n / share)).otherwise(0.0)
            + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / n / (1 - share))).otherwise(0.0))


def fit(signals: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge around `PRIOR`."""
    w = prior = np.array(PRIOR)
    for _ in range(25):
        p = 1 / (1 + np.exp(-signals @ w))
        h = (signals * (p * (1 - p))[:, None]).T @ signals + 0.5 * np.eye(len(w))
        w = w - np.linalg.solve(h, signals.T @ (p - labels) + 0.5 * (w - prior))
    return w


class Scorer:
    """Matcher and calibration."""

    def __init__(self, matcher: Matcher, model: np.ndarray):
        self.matcher, self.model = matcher, model

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        found = np.array([self.matcher.weight(t) if t else (0.0, 0) for t in texts], float)
        return 1 / (1 + np.exp(-_signals(found[:, 0], found[:, 1]) @ self.model))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held: int = 1, rows: int = TRAINING_ROWS, exceptions: tuple[str, ...] = EXCEPTIONS,
          text: str = "text", id: str = "doc_id") -> Scorer:
    """Lexicon and calibration from the labelled rows whose crc32(id) mod `folds` is not `held`."""
    sample = durable(training_rows(docs, labels, label, F.pmod(crc_of("id"), F.lit(folds)) != held, rows, text, id))
    lexicon, learnt = learn_lexicon(sample)
    matcher = Matcher(lexicon, (*exceptions, *learnt), frozenset(map(skeleton, BASE)))

    def weigh(batches):
        for batch in batches:
            found = [matcher.weight(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())], names=["label", "weight", "words"])

    # three numbers for each row of the bounded sample
    seen = sample.mapInArrow(weigh, "label int, weight double, words long").toPandas()
    return Scorer(matcher, fit(_signals(seen["weight"].to_numpy(), seen["words"].to_numpy()), seen["label"].to_numpy()))


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, least: float = 0.7, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """One row per row of `docs`: (id, held_out, score, predicted). Null ids take no part in training."""
    scorer = train(docs, labels, folds=folds, held=held, text=text, id=id, **options)

    def apply(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("crc"), pa.array(scorer(batch.column("text").to_pylist()), pa.float64())], names=["id", "crc", "score"])

    rows = docs.select(F.col(id).alias("id"), crc_of(id).alias("crc"), F.col(text).alias("text")).mapInArrow(apply, f"id {docs.schema[id].dataType.simpleString()}, crc long, score double")
    return rows.select(F.col("id").alias(id), F.coalesce(F.pmod("crc", F.lit(folds)) == held, F.lit(True)).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.7, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that score below `least`."""
    scorer = train(docs, labels, text=text, id=id)

    @F.pandas_udf("double")
    def rate(texts: pd.Series) -> pd.Series:
        return pd.Series(scorer([t if isinstance(t, str) else None for t in texts]))

    return docs.where(rate(F.col(text)) < least)
