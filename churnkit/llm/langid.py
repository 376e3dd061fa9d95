"""Language identification by multilingual mixture inference.

Model: for each language the frequencies of hashed character 1- to 3-grams of
its training texts, counted by Spark over all of them and smoothed.  Inference:
a document is a mixture of languages; expectation-maximisation estimates the
share of each language from the likelihoods of its n-grams.  The set of
languages is chosen by penalised likelihood: starting with the best single
language, the language whose addition raises the log-likelihood most is added
while the gain exceeds the penalty.  The language with the largest share is
predicted; the score is its share.

A letter is a character for which ``str.isalpha`` holds; every other character
separates words.  Letters are lower-cased.

Defined cases: null text or a text without letters is ``und`` with score 0;
documents with a null language, and null texts, teach nothing; equal shares go
to the language that sorts first; repeated rows are predicted each alike; an
empty training set makes every prediction ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import chunks, drop_caches, free_names, mix

UNDETERMINED = "und"
_FOLD: list[np.ndarray] = []
_CHARS = 200_000  # characters handled at once in a task; a longer text is handled alone


@dataclass(frozen=True)
class LanguageModel:
    """languages, and log P(gram | language) as features x languages."""

    languages: list[str]
    log_p: np.ndarray


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, or a space for anything but letters."""
    if not _FOLD:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def grams(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed grams of all texts: (feature, text number, letters per text)."""
    joined = " ".join(t or "" for t in texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = _fold()[points]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t or "") + 1 for t in texts])
    letter = folded != 32
    letters = np.bincount(owner[letter], minlength=len(texts))
    # One space between words; the text's own edges count as spaces too.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[-1] = True
    c, own = folded[keep].astype(np.uint64), owner[keep]
    space = c == 32
    shift = np.uint64(64 - bits)
    one = np.uint64(0x9E3779B97F4A7C15)
    features, owners = [], []
    for n in (1, 2, 3):
        m = len(c) - n + 1
        if m <= 0:
            continue
        code = c[:m].copy()
        ok = ~space[:m] if n == 1 else ~(space[:m] & space[1: m + 1])
        ok &= own[:m] == own[n - 1:]
        for k in range(1, n):
            code = (code << np.uint64(21)) | c[k: k + m]
            if 0 < k < n - 1:
                ok &= ~space[k: k + m]
        features.append((mix(code * one + np.uint64(n)) >> shift)[ok].astype(np.int64))
        owners.append(own[:m][ok])
    if not features:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), letters
    return np.concatenate(features), np.concatenate(owners), letters


def train(spark: SparkSession, docs: DataFrame, *, bits: int = 14, smoothing: float = 0.5) -> LanguageModel:
    """Count the grams of all rows of ``docs`` (text, lang).

    Only languages x 2**bits counts reach the driver, whatever the size of ``docs``.
    """
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in chunks([len(t) for t in texts], _CHARS):
                features, owners, _ = grams(texts[i:j], bits)
                names = sorted(set(langs[i:j]))
                number = np.array([names.index(x) for x in langs[i:j]])[owners]
                table = np.bincount(number * size + features, minlength=len(names) * size).reshape(len(names), size)
                for k, name in enumerate(names):
                    sums[name] = sums.get(name, 0) + table[k]
        for name, row in sums.items():
            f = np.flatnonzero(row)
            yield pa.record_batch([pa.array([name] * len(f)), pa.array(f), pa.array(row[f])], ["lang", "feature", "n"])

    taught = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    rows = (taught.mapInArrow(count, "lang string, feature long, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique().tolist())
    table = np.zeros((len(languages), size))
    if languages:
        table[rows["lang"].map({x: k for k, x in enumerate(languages)}), rows["feature"]] = rows["n"]
    table += smoothing
    return LanguageModel(languages, np.log(table / table.sum(1, keepdims=True)).T.astype(np.float32))


def _mixture(p: np.ndarray, count: np.ndarray, doc: np.ndarray, starts: np.ndarray, allowed: np.ndarray,
             rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares per document over its allowed languages, and the log-likelihood they reach."""
    total = np.add.reduceat(count, starts)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        weighted = p * share[doc]
        weighted *= (count / weighted.sum(1))[:, None]
        share = np.add.reduceat(weighted, starts, axis=0) / total[:, None]
    like = np.add.reduceat(count * np.log((p * share[doc]).sum(1)), starts)
    return share, like


def infer(features: np.ndarray, owners: np.ndarray, texts: int, model: LanguageModel, rounds: int,
          penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(language number or -1, share) of each of ``texts`` documents."""
    best, score = np.full(texts, -1), np.zeros(texts)
    languages = len(model.languages)
    if not languages or not len(features):
        return best, score
    size = len(model.log_p)
    cell, count = np.unique(owners.astype(np.int64) * size + features, return_counts=True)
    doc, feature = cell // size, cell % size
    present, starts = np.unique(doc, return_index=True)
    doc = np.searchsorted(present, doc)
    count = count.astype(np.float64)
    logs = model.log_p[feature].astype(np.float64)
    top = logs.max(1)
    p = np.exp(logs - top[:, None])  # scaled per gram; the scale cancels in every comparison
    single = np.add.reduceat(count[:, None] * logs, starts, axis=0)
    shift = np.add.reduceat(count * top, starts)
    first = single.argmax(1)
    n = len(present)
    share = np.zeros((n, languages))
    share[np.arange(n), first] = 1
    like = single.max(1)
    cost = penalty * np.log(np.add.reduceat(count, starts))
    open_ = np.arange(n)
    chosen = share > 0
    for _ in range(languages - 1):
        if not len(open_):
            break
        # Only documents whose set grew in the last step can grow again.
        mark = np.isin(doc, open_)
        sub_p, sub_count, sub_doc = p[mark], count[mark], np.searchsorted(open_, doc[mark])
        sub_starts = np.flatnonzero(np.diff(sub_doc, prepend=-1))
        gain, shares = np.full((len(open_), languages), -np.inf), np.zeros((languages, len(open_), languages))
        for k in range(languages):
            trial = chosen[open_].copy()
            trial[:, k] = True
            s, ll = _mixture(sub_p, sub_count, sub_doc, sub_starts, trial.astype(float), rounds)
            gain[:, k] = np.where(chosen[open_, k], -np.inf, ll + shift[open_] - like[open_])
            shares[k] = s
        pick = gain.argmax(1)
        better = gain[np.arange(len(open_)), pick] > cost[open_]
        grown, pick, at = open_[better], pick[better], np.flatnonzero(better)
        chosen[grown, pick] = True
        share[grown] = shares[pick, at]
        like[grown] += gain[at, pick]
        open_ = grown
    best[present] = share.argmax(1)
    score[present] = np.clip(share.max(1), 0, 1)
    return best, score


def identify(docs: DataFrame, model: LanguageModel, *, rounds: int = 8, penalty: float = 2.0,
             out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with its predictions in two more columns, named ``out``; input columns of these names are replaced."""
    bits = len(model.log_p).bit_length() - 1
    names = [c for c in docs.columns if c not in out]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            langs, scores = [], []
            for i, j in chunks([len(t or "") for t in texts], _CHARS):
                features, owners, letters = grams(texts[i:j], bits)
                best, score = infer(features, owners, j - i, model, rounds, penalty)
                langs += [model.languages[b] if b >= 0 and n else UNDETERMINED for b, n in zip(best, letters)]
                scores += [float(s) if n else 0.0 for s, n in zip(score, letters)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*names, *out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)
    return (docs.select(*[F.col(f"`{c}`") for c in names], F.col("text").alias("__text"))
            .mapInArrow(predict, f"{fields}{', ' if fields else ''}`{out[0]}` string, `{out[1]}` double"))


def held_out() -> "F.Column":
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def label_languages(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that are not held out.

    A null doc_id has no remainder: such a row is neither held out nor learned from.
    """
    flagged = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    model = train(spark, docs.where(~held_out()))
    out = identify(flagged.select("doc_id", "held_out", "text"), model, **options)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, *, least_share: float = 0.5, **options) -> DataFrame:
    """The documents with a dominant language: rejected are those without letters and those whose
    largest language has less than ``least_share`` of the text.  The columns stay as they are."""
    model = train(spark, docs.where(~held_out()))
    language, share = free_names(docs, 2)
    out = identify(docs, model, out=(language, share), **options)
    return (out.where((F.col(language) != UNDETERMINED) & (F.col(share) >= least_share))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
