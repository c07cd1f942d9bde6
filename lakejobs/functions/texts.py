"""Text jobs as column expressions and shuffles keyed by document.

The labels and scores are plain rules (lexicons, patterns, word overlap). A caller
with a model passes a function to ``infer``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One pattern per entity kind.
ENTITY_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "url": r"https?://[^\s]+",
    "phone": r"\+?[0-9][0-9() -]{7,}[0-9]",
    "number": r"[0-9]+(?:\.[0-9]+)?",
}

# Small default sentiment lexicon.
POSITIVE = ("good", "great", "love", "excellent", "happy", "best", "nice", "perfect", "thanks")
NEGATIVE = ("bad", "poor", "hate", "terrible", "sad", "worst", "broken", "problem", "error")


def words(text: Column | str) -> Column:
    """Lower-case words split at white space, in order, over the whole text."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def count_in(items: Column, lexicon: Sequence[str]) -> Column:
    return F.size(F.filter(items, lambda w: w.isin(*lexicon)))


def sentiment(text: Column | str, positive: Sequence[str] = POSITIVE, negative: Sequence[str] = NEGATIVE) -> Column:
    """positive, negative, mixed or neutral by lexicon counts."""

    def label(items: Column) -> Column:
        up, down = count_in(items, positive), count_in(items, negative)
        return F.when(up > down, "positive").when(up < down, "negative").when(up > 0, "mixed").otherwise("neutral")

    return bind(words(text), label)


def classify(text: Column | str, labels: dict[str, Sequence[str]]) -> Column:
    """Label with the most keyword hits; ties go to the label named first."""

    def best(items: Column) -> Column:
        scores = [F.struct(count_in(items, keys).alias("hits"), F.lit(-i).alias("rank"), F.lit(name).alias("label"))
                  for i, (name, keys) in enumerate(labels.items())]
        return F.array_max(F.array(*scores))["label"]

    return bind(words(text), best)


def extract(text: Column | str, kinds: Sequence[str]) -> Column:
    """Struct with the first match of each kind, NULL where there is none."""
    return F.struct(*[F.nullif(F.regexp_extract(text, ENTITY_PATTERNS[k], 0), F.lit("")).alias(k) for k in kinds])


# The same matches found without trying every character of a long word: a run of local-part characters is
# entered only at its start or where the last match ended, and never given back.
EMAIL_SCAN = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def mask_entities(text: Column | str, kinds: Sequence[str]) -> Column:
    """Replace every match of the chosen kinds, in the order given."""
    column = F.col(text) if isinstance(text, str) else text
    for kind in kinds:
        if kind == "email":
            column = F.when(column.contains("@"), F.regexp_replace(column, EMAIL_SCAN, "[MASKED]")).otherwise(column)
        else:
            column = F.regexp_replace(column, ENTITY_PATTERNS[kind], "[MASKED]")
    return column


SENTENCE_END = r"(?<=[.!?])[ \t\n\x0B\f\r]+|\n+"
BLANK = r"[ \t\n\x0B\f\r]+"


def best_sentences(text: str | None, max_words: int) -> list[int] | None:
    """Positions of the best sentences of a lower-cased text, up to ``max_words`` words."""
    if text is None:
        return None
    sentences = [[w for w in re.split(BLANK, s) if w] for s in re.split(SENTENCE_END, text)]
    in_text = Counter(w for tokens in sentences for w in tokens)
    ranked = sorted((-(sum(in_text[w] for w in tokens) / len(tokens)), at, len(tokens)) for at, tokens in enumerate(sentences) if tokens)
    kept, used = [], 0
    for _, at, n_words in ranked:
        used += n_words
        if used > max_words:
            break
        kept.append(at)
    return sorted(kept)


def summarize(df: DataFrame, key: str, text: str, max_words: int) -> DataFrame:
    """Best sentences of each text, in text order, up to ``max_words`` words.

    A sentence scores the mean in-text frequency of its words. All of it lies in
    one text, so rows stay where they are and no word is shuffled; a task holds the
    words of one text at a time.
    """
    kept = F.udf(lambda lowered: best_sentences(lowered, max_words), "array<int>", useArrow=False)(F.lower(text))
    placed = df.select(key, F.split(F.col(text), SENTENCE_END).alias("_pieces"), kept.alias("_kept"))
    chosen = F.transform("_kept", lambda at: F.get(F.col("_pieces"), at))
    return placed.select(key, F.coalesce(F.concat_ws(" ", chosen), F.lit("")).alias("summary"))


def infer(
    df: DataFrame, prompt: str, output: str, model: Callable[[list[str]], list[str]], batch_size: int = 64
) -> DataFrame:
    """Call a batch model on each row's prompt inside Arrow batches; rows stay where they are."""
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prompts = batch[prompt].tolist()
            answers: list[str] = []
            for at in range(0, len(prompts), batch_size):
                answers += model(prompts[at : at + batch_size])
            yield batch.assign(**{output: answers})

    return df.mapInPandas(run, schema)


def overlap_share(response: Column | str, expected: Column | str) -> Column:
    """Share of the expected distinct words that the response has."""
    want = F.array_distinct(words(expected))
    return F.try_divide(F.size(F.array_intersect(words(response), want)), F.size(want))
