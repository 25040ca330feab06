"""Line deduplication by winnowing over line hashes (DataFrame functions only).

A document is a sequence of hashes of its lines that aren't blank.  From each line a *window* reaches over
``width`` lines, or fewer if these hold ``long_words`` words together.  The least hash of a window, the
leftmost of equals, is selected: its value is a *fingerprint* and its line a *position*.  Neighbouring
windows mostly select the same position, and equal windows are sure to select equal ones.

1. Positions are counted by fingerprint; one that stands at a single position can't be part of a repeat.
2. The other positions are joined by fingerprint and each match is extended both ways, over the lines of
   every window that selects the position: before and after it.  Of the places that agree in fingerprint,
   lines before and lines after the first in order of (doc_id, text hash, line) is kept.
3. Extended matches that overlap make up a run of any length.  Every line of a run that stands elsewhere
   earlier is deleted; so the first of several runs stays, and no pairs of places are made.

So a repeat of at least ``width`` lines, or of at least ``long_words`` words, is found without exception.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, stash

BLANK = r"^[\\x09-\\x0D\\x20]*$"
WORD = r"[^\\x20\\x09-\\x0D]+"
WIDTH = 3
LONG_WORDS = 12


def windows(docs: DataFrame, width: int, long_words: int) -> DataFrame:
    """One row a window: (doc_id, th, lines, fp, match, first).

    ``lines`` are its line numbers, ``match`` its fingerprint with the hashes of its lines before and after
    the position; ``first``: no window further left selects the same position.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.split("text", "\n", -1).alias("l"))
    seq = rows.selectExpr(
        "doc_id", "th",
        f"filter(transform(l, (x, i) -> named_struct('i', i, 'h', xxhash64(x), 'n', least(regexp_count(x, '{WORD}'), {long_words}), 'blank', x rlike '{BLANK}')), x -> NOT x.blank) AS s",
    )
    # The number of lines of the window from line k (from 0), null where the text ends before it does.
    ends = [" + ".join(f"s[k + {i}].n" for i in range(m + 1)) for m in range(width - 1)]
    size = "CASE " + " ".join(f"WHEN k + {m} < size(s) AND ({e}) >= {long_words} THEN {m + 1}" for m, e in enumerate(ends)) + f" WHEN k + {width} <= size(s) THEN {width} END"
    reach = seq.selectExpr("doc_id", "th", "s", f"transform(s, (x, k) -> {size}) AS m")
    least = reach.selectExpr("doc_id", "th", "s", "m", "transform(m, (m, k) -> CASE WHEN m IS NOT NULL THEN k + array_position(transform(slice(s, k + 1, m), x -> x.h), array_min(transform(slice(s, k + 1, m), x -> x.h))) - 1 END) AS p")
    each = least.selectExpr(
        "doc_id", "th",
        """inline(filter(transform(m, (m, k) -> named_struct(
            'lines', transform(slice(s, k + 1, coalesce(m, 0)), x -> x.i), 'fp', s[p[k]].h,
            'match', named_struct('fp', s[p[k]].h, 'before', transform(slice(s, k + 1, coalesce(p[k] - k, 0)), x -> x.h), 'after', transform(slice(s, p[k] + 2, coalesce(k + m - 1 - p[k], 0)), x -> x.h)),
            'first', k = 0 OR NOT p[k] <=> p[k - 1])), w -> w.fp IS NOT NULL))""",
    )
    return each


def removed_lines(docs: DataFrame, width: int = WIDTH, long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, th, words): the lines to delete of each document that has any, as 64-bit words (w, bits)."""
    every = stash(windows(docs, width, long_words), "line-windows")
    place = F.struct("doc_id", "th", F.element_at("lines", 1).alias("at"))
    # Tables of their own beside the joins: a frequent fingerprint's rows can be split over tasks.
    shared = stash(every.filter("first").groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp"), "fingerprints")
    joined = every.join(shared, "fp")
    earliest = stash(joined.groupBy("match").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("match", "earliest"), "first-places")
    later = every.join(earliest, "match").filter(place > F.col("earliest"))
    lines = later.select("doc_id", "th", F.explode("lines").alias("i"))
    words = lines.groupBy("doc_id", "th", F.shiftright("i", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, i & 63))").alias("bits"))
    return words.groupBy("doc_id", "th").agg(F.collect_list(F.struct("w", "bits")).alias("words"))


def dedup_lines(docs: DataFrame, names: tuple[str, str, str], width: int = WIDTH, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with columns ``names``: the text without the deleted lines, how many lines, how many deleted.

    Null text has no lines and stays null; blank lines are never deleted; without a deleted line the text
    stays as it was.  Rows with equal doc_id (null too) and text are one place: neither is later than the
    other and both are treated alike.  Rows with equal doc_id and other texts are told apart by the
    text's hash.  Other columns are carried along, whatever their names; an empty table gives an empty result.
    """
    kept, lines, removed = names
    doc, th, words = fresh(docs, "doc", "th", "words")
    gone = removed_lines(docs.select("doc_id", "text"), width, long_words).toDF(doc, th, words)
    both = docs.join(gone, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(th)), "left")
    deleted = f"exists({words}, w -> w.w = shiftright(i, 6) AND (shiftright(w.bits, i & 63) & 1) = 1)"
    return both.select(
        *[docs[c] for c in docs.columns],
        F.expr(f"CASE WHEN {words} IS NULL THEN text ELSE array_join(filter(split(text, '\\n', -1), (x, i) -> NOT {deleted}), '\\n') END").alias(kept),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias(lines),
        F.expr(f"CAST(CASE WHEN {words} IS NULL THEN 0 ELSE aggregate({words}, 0, (n, w) -> n + bit_count(w.bits)) END AS BIGINT)").alias(removed),
    )


def report(docs: DataFrame, width: int = WIDTH, long_words: int = LONG_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 for every document."""
    got = dedup_lines(docs.select("doc_id", "text"), ("kept", "n_lines", "n_removed"), width, long_words)
    return got.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def keep_first_lines(docs: DataFrame, width: int = WIDTH, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted; a document that has nothing left is dropped.

    A column ``n_chars`` follows the text.  Null, empty and blank texts stay as they are, and so do all
    texts without a repeat; repeated rows stay together or go together; see :func:`dedup_lines`.
    """
    kept, lines, removed = fresh(docs, "kept", "lines", "removed")
    got = dedup_lines(docs, (kept, lines, removed), width, long_words)
    empty = (F.col(removed) > 0) & F.col(kept).rlike(r"^[\x09-\x0D\x20]*$")
    new = {"text": F.col(kept)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(removed) > 0, F.length(kept)).otherwise(F.col("n_chars")).cast("long")
    return got.filter(~F.coalesce(empty, F.lit(False))).select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
