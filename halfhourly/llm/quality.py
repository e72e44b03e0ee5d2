"""Quality rules: distribution divergence from language references.

Every document is reduced to two histograms: character classes of all its
characters, and lengths/common words of its words.  The references are the sums
of the same histograms over all documents of the language that pass the base
rules, so they follow the corpus; a document is rejected if the Jensen-Shannon
distance (square root of the divergence, base 2, so 0 to 1) of either histogram
to its language's reference exceeds the threshold.  Short texts have noisy
histograms, so each comparison has a minimum length below which it is skipped:
of the document, and for words of the reference too.

Two passes over the text: the first counts per language (a map-side dictionary
per batch, then one grouped sum, so a hot language costs nothing), the second
scores with the references, a table of one row a language.  Every language is judged
by its own reference, however rare it is: one whose documents hold fewer than
MIN_REFERENCE_WORDS words has no word histogram to compare with, and its documents are
judged by the base rules and their characters.  Up to COLLECTED_LANGS languages the
references travel with the tasks; beyond, the table is joined by language and salt, with the same result.

Defined cases: null text = no words, base_failed; empty table = empty result; the documents without
a language are judged like a language of their own; repeated rows are judged one by one (same result);
doc_id may be null and is carried through; extra columns are ignored by
``score`` and kept by ``keep``.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from halfhourly.llm.common import materialize, rebatch, space_words

#: Character classes: lower, upper, digit, space, sentence marks, symbols, other
#: marks, letters without case or beyond ASCII.
CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other", "wide")
SYMBOLS = "#*$%&|<>"
TOP_WORDS = 64
COLLECTED_LANGS = 1000   # references kept in the tasks; more are joined
SALTS = 64               # parts of a language in that join
MIN_CHARS = 200          # character histogram judged from here
MIN_WORDS = 100          # word histogram judged from here
CHAR_LIMIT = 0.29
WORD_LIMIT = 0.42
MIN_REFERENCE_WORDS = 5000  # words a language must hold for its word histogram to tell anything

SCORED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, char_distance double, word_distance double, kept boolean")


def _class_table() -> np.ndarray:
    table = np.full(0x300, 7, np.uint8)
    for c in range(128):
        ch = chr(c)
        table[c] = (0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit()
                    else 3 if c == 32 or 9 <= c <= 13 else 4 if ch in ".,;:'\"?-()"
                    else 5 if ch in SYMBOLS + "!@^~=+{}[]\\/_`" else 6)
    for c in range(128, 0x300):
        ch = chr(c)
        table[c] = 0 if ch.islower() else 1 if ch.isupper() else 6 if c < 0xC0 else 7
    return table


_CLASS_OF = _class_table()


def char_histogram(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = codes[codes < 0x300]
    hist = np.bincount(_CLASS_OF[small], minlength=len(CLASSES))
    hist[7] += len(codes) - len(small)
    return hist


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n = len(words)
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
    repeat = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        seen = Counter(windows)
        if len(seen) < len(windows):
            hit = np.zeros(n, bool)
            at = np.fromiter((seen[w] > 1 for w in windows), bool, n - 2)
            for k in range(3):
                hit[k:n - 2 + k] |= at
            repeat = int(hit.sum())
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeat


def base_fails(n_words: int, n_repeat: int) -> bool:
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors, base 2."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def half(a: np.ndarray) -> float:
        on = a > 0
        return float((a[on] * np.log2(a[on] / m[on])).sum())
    return float(np.sqrt(max(0.0, (half(p) + half(q)) / 2)))


def _bare(words: list[str]) -> list[str]:
    return [w.strip(".,;:!?") for w in words]


def _count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch: counts per language of characters ('c') and words ('w') over the documents that pass the base rules."""
    def rows(counts: dict) -> pd.DataFrame:
        return pd.DataFrame([(lang, kind, item, n) for (lang, kind), c in counts.items() for item, n in c.items()],
                            columns=["lang", "kind", "item", "n"])
    counts: dict = {}
    held = 0
    for pdf in rebatch(it, "text"):
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            if text is None:
                continue
            words = space_words(text)
            if base_fails(len(words), base_counts(text, words)[4]):
                continue
            bare = Counter(_bare(words))
            bare.pop("", None)
            for key, c in (("c", dict(zip(CLASSES, char_histogram(text).tolist(), strict=True))),
                           ("w", bare)):
                counts.setdefault((lang, key), Counter()).update(c)
        held = sum(map(len, counts.values()))
        if held > 400_000:
            yield rows(counts)
            counts = {}
    if counts:
        yield rows(counts)


def references(docs: DataFrame) -> DataFrame:
    """(lang, reference): one row a language, its class counts, common words and word total as JSON.

    The top words of each language come from a two-level top-k (per language and
    salt, then per language), so a language with all the vocabulary is spread over
    many tasks; a reference has TOP_WORDS + classes + 1 entries at most."""
    counts = materialize(
        docs.select("lang", "text").mapInPandas(_count, "lang string, kind string, item string, n long")
        .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), "quality-counts")
    words = counts.filter("kind = 'w'")
    order = [F.desc("n"), F.col("item")]
    top = words.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        top = (top.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
               .filter(F.col("rank") <= TOP_WORDS))
    sums = (words.groupBy("lang").agg(F.sum("n").alias("n"))
            .select("lang", F.lit("all").alias("kind"), F.lit("").alias("item"), "n"))
    entries = (top.select("lang", "kind", "item", "n").unionByName(sums)
               .unionByName(counts.filter("kind = 'c'").select("lang", "kind", "item", "n")))
    return materialize(entries.groupBy("lang").agg(
        F.to_json(F.collect_list(F.struct("kind", "item", "n"))).alias("reference")), "quality-references")


def parse(reference: str | None):
    """(class counts, {common word: index}, word counts) of a language; None where it has no passing document."""
    if reference is None:
        return None
    kinds: dict = {}
    for e in json.loads(reference):
        kinds.setdefault(e["kind"], {})[e["item"]] = e["n"]
    common = sorted(kinds.get("w", {}).items(), key=lambda x: (-x[1], x[0]))
    n_all = kinds.get("all", {}).get("", 0)
    return (np.array([kinds["c"].get(c, 0) for c in CLASSES], float), {w: i for i, (w, _) in enumerate(common)},
            np.array([n for _, n in common] + [n_all - sum(n for _, n in common)], float))


def divergences(text: str, words: list[str], reference) -> tuple[float | None, float | None]:
    """(character distance, word distance); None where the text is too short to tell."""
    if reference is None:
        return None, None
    classes, index, common = reference
    char = js_distance(char_histogram(text).astype(float), classes) if len(text) >= MIN_CHARS else None
    word = None
    if len(words) >= MIN_WORDS and common.sum() >= MIN_REFERENCE_WORDS:
        hist = np.zeros(len(common))
        get, other = index.get, len(common) - 1
        np.add.at(hist, np.fromiter((get(w, other) for w in _bare(words)), np.int64, len(words)), 1)
        word = js_distance(hist, common)
    return char, word


def _referenced(docs: DataFrame) -> tuple[DataFrame, dict | None]:
    """``docs`` with __quality_ref, and the references by language where they are few (the column is null then)."""
    refs = references(docs)
    few = refs.limit(COLLECTED_LANGS + 1).collect()
    if len(few) <= COLLECTED_LANGS:
        return docs.withColumn("__quality_ref", F.lit(None).cast("string")), {r.lang: parse(r.reference) for r in few}
    dealt = refs.select(F.col("lang").alias("__quality_lang"), F.col("reference").alias("__quality_ref"),
                        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__quality_salt"))
    salt = F.pmod(F.xxhash64("text"), F.lit(SALTS))
    return docs.join(dealt, docs.lang.eqNullSafe(F.col("__quality_lang")) & (salt == F.col("__quality_salt")), "left"), None


def _judge(refs: dict | None, limits: tuple[float, float]):
    own: dict = {}

    def judge(text: str | None, lang: str | None, reference: str | None) -> tuple:
        text = text or ""
        words = space_words(text)
        counts = base_counts(text, words)
        failed = base_fails(counts[0], counts[4])
        if refs is None and lang not in own:
            if len(own) >= COLLECTED_LANGS:
                own.clear()
            own[lang] = parse(reference)
        char, word = divergences(text, words, (own if refs is None else refs).get(lang))
        odd = (char is not None and char > limits[0]) or (word is not None and word > limits[1])
        return (*counts, failed, char, word, not failed and not odd)
    return judge


def score(docs: DataFrame, limits: tuple[float, float] = (CHAR_LIMIT, WORD_LIMIT)) -> DataFrame:
    """One row per document: base counts, both distances (null: too short) and ``kept``."""
    own, refs = _referenced(docs.select("doc_id", "lang", "text"))
    judge = _judge(refs, limits)
    names = [c.split()[0] for c in SCORED.split(", ")]

    def run(it):
        for pdf in rebatch(it, "text"):
            rows = [judge(*r) for r in zip(pdf["text"], pdf["lang"], pdf["__quality_ref"], strict=True)]
            out = pd.DataFrame(rows, columns=names[1:])
            out.insert(0, "doc_id", pdf["doc_id"])
            yield out
    return own.select("doc_id", "lang", "text", "__quality_ref").mapInPandas(run, SCORED)


def keep(docs: DataFrame, limits: tuple[float, float] = (CHAR_LIMIT, WORD_LIMIT)) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    own, refs = _referenced(docs)
    judge = _judge(refs, limits)
    verdict = F.pandas_udf(
        lambda text, lang, ref: pd.Series([judge(*r)[-1] for r in zip(text, lang, ref, strict=True)], dtype=bool), "boolean")
    return own.filter(verdict("text", "lang", "__quality_ref")).select(*[F.col(f"`{c}`") for c in docs.columns])
