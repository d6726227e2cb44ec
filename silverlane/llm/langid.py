"""Language identification by a mixture of languages in each document.

A document's words are drawn from languages in unknown proportions. The likelihood of a word in a
language comes from character n-grams counted on a bounded sample of labelled documents.
Expectation-maximisation estimates the proportions, and the set of languages is the one whose
likelihood, less a penalty for each language, is greatest: languages are taken away one by one as long as
that pays. The prediction is the language of the largest proportion.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlane.llm.store import pick, stored

UNKNOWN = "und"
#: Labelled documents of each language that the model is fitted on, at most.
SAMPLE = 1000
PARTS = 16
#: Orders of the character n-grams; n-grams and their contexts are counted in buckets, of which there are so many.
ORDER = 3
BUCKETS = 1 << 18
#: What is added to the count of an n-gram, and how many n-grams a context is thought to have.
SMOOTHING = 0.05
FOLLOWERS = 40
#: How far below its maximum a document's log-likelihood may be when expectation-maximisation ends, and what each
#: language costs, in times of the logarithm of the number of words.
TOLERANCE = 0.01
PENALTY = 2.0
#: Share of its words that a language must have for a document to be accepted as one in it.
LEAST = 0.5
#: Words of documents that are worked on together.
BLOCK_WORDS = 400_000
#: Runs of letters: word characters but decimal digits, which in rare texts have other numerals among them.
WORD = re.compile(r"[^\W\d_]+")
NUMERALS = [c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
SUSPECT = re.compile("[" + "".join(c for c in NUMERALS if ord(c) < 0x10000) + "\U00010000-\U0010ffff]")
BLANKED = dict.fromkeys(map(ord, NUMERALS), " ")


def words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    if not text:
        return []
    if not text.isascii() and SUSPECT.search(text):
        text = text.translate(BLANKED)
    return WORD.findall(text.lower())


def grams(spelled: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of these words: the bucket of each n-gram, that of its context, and the word it is from.

    Words are taken between two marks; an n-gram's context is its first ORDER - 1 characters.
    """
    sizes = np.fromiter(map(len, spelled), np.int64, len(spelled)) + ORDER
    line = "".join([f"  {w} " for w in spelled])
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(spelled)), sizes)
    context = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    gram = (context ^ codes[2:]) * np.uint64(0xD6E8FEB86659FD93)
    inside = word[2:] == word[:-2]
    shift = np.uint64(65 - BUCKETS.bit_length())
    bucket = lambda x: ((x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> shift).astype(np.int64)
    return bucket(gram[inside]), bucket(context[inside]), word[2:][inside]


class Model:
    """Logarithms of the weights of n-grams and of their contexts in each language, by bucket."""

    def __init__(self, languages: list[str], grams: np.ndarray, contexts: np.ndarray):
        self.languages, self.grams, self.contexts = languages, grams, contexts

    @classmethod
    def of_counts(cls, languages: list[str], grams: np.ndarray, contexts: np.ndarray) -> Model:
        """From counts by language and bucket; SMOOTHING stands for every n-gram, and FOLLOWERS for a context."""
        logs = np.log(grams + SMOOTHING), np.log(contexts + SMOOTHING * FOLLOWERS)
        return cls(languages, *(x.T.astype(np.float32) for x in logs))

    def likelihood(self, spelled: list[str]) -> np.ndarray:
        """Logarithm of the probability of each word in each language."""
        gram, context, word = grams(spelled)
        terms = self.grams[gram] - self.contexts[context]
        starts = np.searchsorted(word, np.arange(len(spelled)))
        return np.add.reduceat(terms, starts, axis=0).astype(np.float64)

    def mixtures(self, texts: list[str | None]) -> np.ndarray:
        """The proportions of all languages in each text; zero for all in a text without words."""
        number: dict[str, int] = {}
        counted = [Counter(words(t)) for t in texts]
        ids = [np.fromiter((number.setdefault(w, len(number)) for w in c), np.int64, len(c)) for c in counted]
        out = np.zeros((len(texts), len(self.languages)))
        some = [k for k, c in enumerate(counted) if c]
        if not some or not self.languages:
            return out
        log_p = self.likelihood(list(number))[np.concatenate([ids[k] for k in some])]
        times = np.concatenate([np.fromiter(counted[k].values(), np.float64, len(counted[k])) for k in some])
        starts = np.cumsum([0, *(len(ids[k]) for k in some)])[:-1]
        out[some] = select(log_p, times, starts)
        return out


def estimate(log_p: np.ndarray, times: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions among the allowed languages of each document, and its log-likelihood under them.

    Documents are runs of rows that begin at `starts`; a row has the likelihoods of a word and how often it occurs.
    A round multiplies each proportion by a factor. As the log-likelihood is concave, its maximum is no further than the
    number of words times the logarithm of the greatest factor: a document ends when that is below TOLERANCE, or
    when rounding hides what a round gains. Rounds alone creep where languages are close, so after every two the
    change is extrapolated (squared, with the step length of the two differences), and the place it leads
    to is taken if it is at least as likely.
    """
    doc = np.repeat(np.arange(len(starts)), np.diff([*starts, len(times)]))
    masked = np.where(allowed[doc], log_p, -np.inf)
    top = masked.max(axis=1)
    p = np.exp(masked - top[:, None])
    share = allowed / allowed.sum(axis=1, keepdims=True)
    size = np.add.reduceat(times, starts)
    # What is left of documents that have not ended: their numbers, rows, times, places among those left, and starts.
    open_, left, n, at, begin = np.arange(len(starts)), p, times, doc, starts

    def proper(x: np.ndarray) -> np.ndarray:
        x = np.maximum(x, 1e-15) * allowed[open_]
        return x / x.sum(axis=1, keepdims=True)

    def step(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A round from here, and the log-likelihood here."""
        each = left * x[at]
        mix = each.sum(axis=1)
        each *= (n / mix)[:, None]
        return np.add.reduceat(each, begin, axis=0) / size[open_][:, None], np.add.reduceat(n * np.log(mix), begin)

    while len(open_):
        here = share[open_]
        first, likely = step(here)
        factor = np.divide(first, here, out=np.zeros_like(first), where=allowed[open_]).max(axis=1)
        first = proper(first)
        share[open_] = first
        still = size[open_] * np.log(factor) >= TOLERANCE
        if still.any():
            second, likely_first = step(first)
            second = proper(second)
            change = first - here
            bend = second - first - change
            length = np.linalg.norm(change, axis=1) / np.maximum(np.linalg.norm(bend, axis=1), 1e-300)
            length = np.clip(length, 1, 1e6)[:, None]
            far = proper(here + 2 * length * change + length**2 * bend)
            beyond, likely_far = step(far)
            better = likely_far >= likely_first
            share[open_] = np.where(better[:, None], proper(beyond), second)
            gain = np.where(better, likely_far, likely_first) - likely
            still &= gain > 1e-14 * np.abs(likely)
        if not still.all():
            rows = still[at]
            left, n, at, open_ = left[rows], n[rows], (np.cumsum(still) - 1)[at[rows]], open_[still]
            begin = np.searchsorted(at, np.arange(len(open_)))
    mixed = np.log((p * share[doc]).sum(axis=1)) + top
    return share, np.add.reduceat(times * mixed, starts)


def select(log_p: np.ndarray, times: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions under the set of languages of greatest penalised likelihood.

    From all languages the one of least proportion goes, down to a single one; the best set on the way counts.
    """
    n, k = len(starts), log_p.shape[1]
    ends = np.append(starts[1:], len(times))
    cost = PENALTY * np.log1p(np.add.reduceat(times, starts))
    best, best_score = np.zeros((n, k)), np.full(n, -np.inf)
    allowed = np.ones((n, k), bool)
    open_ = np.arange(n)
    for size in range(k, 0, -1):
        rows = np.concatenate([np.arange(starts[d], ends[d]) for d in open_]) if len(open_) < n else np.arange(len(times))
        begin = np.cumsum([0, *(ends[open_] - starts[open_])])[:-1]
        share, total = estimate(log_p[rows], times[rows], begin, allowed[open_])
        score = total - cost[open_] * size
        better = score > best_score[open_]
        best[open_[better]], best_score[open_[better]] = share[better], score[better]
        weakest = np.where(allowed[open_], share, np.inf).argmin(axis=1)
        allowed[open_, weakest] = False
    return best


def sample(docs: DataFrame, training: Column, most: int = SAMPLE) -> DataFrame:
    """(lang, text) of at most `most` different training texts of each language, by a hash of the text."""
    from pyspark.sql.window import Window

    known = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = known.select("lang", "text", F.xxhash64("text").alias("hash"))
    # Copies count once. First among parts of a language, so that what meets in the end does not grow with the corpus.
    part = F.pmod("hash", F.lit(PARTS))
    chosen = hashed.select("lang", "hash").distinct()
    for keys in (["lang", part], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
        chosen = chosen.withColumn("k", place).where(F.col("k") <= most).drop("k")
    # A broadcast of at most `most` short rows for each language.
    return hashed.join(F.broadcast(chosen), ["lang", "hash"]).dropDuplicates(["lang", "hash"]).select("lang", "text")


def fit(docs: DataFrame, training: Column, most: int = SAMPLE, text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages in `lang` of the rows where `training` holds. Without any it predicts none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                sums = kept.setdefault(lang, [np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)])
                spelled = words(text.as_py())
                for at in range(0, len(spelled), BLOCK_WORDS):
                    gram, context, _ = grams(spelled[at : at + BLOCK_WORDS])
                    sums[0] += np.bincount(gram, minlength=BUCKETS)
                    sums[1] += np.bincount(context, minlength=BUCKETS)
        for lang, sums in kept.items():
            for kind, total in enumerate(sums):
                at = np.flatnonzero(total)
                columns = [pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(total[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "bucket", "n"])

    some = stored(sample(docs, training, most), "labelled")
    languages = sorted(r["lang"] for r in some.select("lang").distinct().collect())
    counts = some.mapInArrow(count, "lang string, kind int, bucket int, n long").groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # at most two numbers for each language and bucket
    sums = np.zeros((2, len(languages), BUCKETS))
    place = {lang: k for k, lang in enumerate(languages)}
    at = np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)
    sums[table.column("kind").to_numpy(), at, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return Model.of_counts(languages, sums[0], sums[1])


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages) for each row, from its whole text alone.

    `score` is the proportion of the predicted language, `languages` all of the selected set, most frequent
    first. A null text, or one without letters, is `und` with score 0 and no languages. Ties go to the
    language that sorts first. Repeated rows and null ids stay; other columns are not looked at.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("languages", T.ArrayType(T.StringType())),
        ]
    )
    shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            done = 0
            for block in _blocks(batch.column("text")):
                names, scores, sets = [], [], []
                for share in model.mixtures(block):
                    order = [k for k in np.argsort(-share, kind="stable").tolist() if share[k] > 1e-6]
                    sets.append([model.languages[k] for k in order])
                    names.append(sets[-1][0] if order else UNKNOWN)
                    scores.append(min(float(share[order[0]]), 1.0) if order else 0.0)
                columns = [batch.column("doc_id").slice(done, len(block)), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.list_(pa.string()))], names=schema.names)
                done += len(block)

    return rows.mapInArrow(run, schema)


def accepted(
    docs: DataFrame,
    model: Model,
    wanted: Collection[str] | None = None,
    least: float = LEAST,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The rows of `docs` of whose text some wanted language (None: any of the model) has at least this share of the words.

    Their `lang` becomes the wanted language of the largest share, ties to the one that sorts first; whatever label they came
    with is not looked at. A text without letters, in other languages, or mixed of so many that none reaches the
    share goes, and so does a null text. With a model of no language, which cannot tell any text from
    another, all rows with letters stay as they are.
    """
    numbered = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    at, label, shared = docs.columns.index(text), docs.columns.index(lang), _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        asked = [k for k, name in enumerate(model.languages) if wanted is None or name in wanted]
        names = np.array([model.languages[k] for k in asked], object)
        for batch in batches:
            kept, found = [], []
            for block in _blocks(batch.column(at)):
                if not model.languages:
                    kept += [bool(words(x)) for x in block]
                elif not asked:
                    kept += [False] * len(block)
                else:
                    shares = model.mixtures(block)[:, asked]
                    kept += (shares.max(axis=1) >= max(least, 1e-6)).tolist()
                    found += names[shares.argmax(axis=1)].tolist()
            if found:
                batch = batch.set_column(label, batch.schema.field(label), pa.array(found, pa.string()))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)


def _shared(docs: DataFrame, model: Model):
    """The model on all executors: two numbers for each bucket and language."""
    return docs.sparkSession.sparkContext.broadcast((model.languages, model.grams, model.contexts))


def _blocks(texts: pa.Array) -> Iterator[list[str | None]]:
    """Runs of whole texts of about BLOCK_WORDS words."""
    block, chars = [], 0
    for text in texts:
        block.append(text.as_py())
        chars += len(block[-1] or "")
        if chars >= BLOCK_WORDS * 6:
            yield block
            block, chars = [], 0
    if block:
        yield block
