"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions alone.

A line (cut at line feeds, trimmed of spaces, tabs and carriage returns) goes if an
earlier line of the corpus equals it or lies within one edit (insertion, deletion or
substitution of a character).  Earlier means smaller (document id, text hash, line number).

1. Equal lines collapse by two 64-bit hashes to their earliest place.
2. Of two lines one edit apart, the first or the second half is the same.  Half hashes with
   the length they are taken for are counted; only lines that share one go on.  Nothing is lost.
3. Those lines emit all variants with one character of the other half deleted, as hashed keys
   (together with the shared half).  Two kinds of equal keys tell a link: the same deletion
   place in both lines (a substitution), or a line that is the other's variant.
4. Per key only the earliest line of each kind is kept as partner, so a hot key costs
   as many candidate pairs as it has lines.
5. ``levenshtein(a, b, 1)`` verifies each pair on the texts.

With ``chars_per_edit`` the bound grows: two lines may differ by one edit for every so many
characters of the shorter one, up to ``max_edits`` (one edit at least).  For a bound of k
the shorter line is cut into k + 1 segments, of which k edits leave one as it is; the longer line emits
the substrings that can be that segment (the places that k edits allow), for every length that can be
its partner's.  Hashed segments and substrings are joined, ``levenshtein(a, b, k)`` verifies.  No pair is lost.

Rules: null text has no lines and stays null; blank lines stay and are never compared; near
matches ask for ``min_near_chars`` characters (equal lines of any length collapse); a null
document id is the smallest; identical rows (same id and text) are one occurrence, so they
are decided alike; a chain a-b-c loses b and c, each to its predecessor; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, shuffled, staged, table_bytes

MIN_NEAR_CHARS = 16
#: Most edits of a bound that grows with the line: a line emits about a third of its third power in keys.
MAX_EDITS = 4
#: Candidates of so few rows (of some 120 bytes in the driver's memory) and bytes stored are broadcast, others are joined
#: by a shuffle.  The stored size alone tells little: ids and places in order pack to a byte or two.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 8 << 20

AT = ["doc_id", "tie", "line_no"]


def _at(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c).alias(c) for c in AT])


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tie, line_no, line (trimmed) for every line that is not blank."""
    lines = docs.select("doc_id", "tie", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return lines.select(*AT, F.btrim("raw", F.lit(" \t\r")).alias("line")).filter("line <> ''")


def _half_keys(min_near_chars: int) -> Column:
    """Hashes of the halves of a line of n characters, and of the halves a line of n - 1 would share with it."""
    return F.expr(
        f"""case when n >= {min_near_chars} then array(
              xxhash64(0, n, substring(line, 1, n div 2)),
              xxhash64(1, n, substring(line, n div 2 + 1)),
              xxhash64(0, n - 1, substring(line, 1, (n - 1) div 2)),
              xxhash64(1, n - 1, substring(line, (n - 1) div 2 + 2))) end"""
    )


def first_lines(lines: DataFrame, min_near_chars: int) -> DataFrame:
    """h1, h2, first (its earliest place), copies, halves for every distinct line."""
    hashed = lines.select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), _at().alias("at"),
        F.col("line"), F.char_length("line").alias("n"),
    ).withColumn("halves", _half_keys(min_near_chars))
    return hashed.groupBy("h1", "h2").agg(
        F.min("at").alias("first"), F.count("*").alias("copies"), F.min("halves").alias("halves")
    )


def candidates(firsts: DataFrame) -> DataFrame:
    """doc_id, tie, line_no, half, kind for the distinct lines that share a half with another one."""
    halves = firsts.filter("halves is not null").select(F.posexplode("halves").alias("kind", "half"), "first")
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    return halves.join(shuffled(shared), "half", "left_semi").select("first.*", "half", "kind")


def candidate_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The candidates with their lines' texts."""
    owners = found.select("doc_id", "tie").distinct()
    small = table_bytes(found) <= BROADCAST_BYTES and found.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else shuffled
    same = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
    texts = split_lines(docs.join(hint(owners), same(docs, owners, ["doc_id", "tie"]), "left_semi"))
    lines = hint(found.groupBy(*AT).agg(F.collect_list(F.struct("half", "kind")).alias("halves")))
    joined = texts.join(lines, same(texts, lines, AT)).select(*[texts[c] for c in AT], texts["line"], lines["halves"])
    # Identical rows hold the same line at the same place: one of them is enough.
    return joined.dropDuplicates(AT)


def variants(texts: DataFrame) -> DataFrame:
    """key, role (s: same place deleted, w: whole rest, d: rest with a deletion), at."""
    halves = texts.select(_at().alias("at"), "line", F.char_length("line").alias("n"), F.explode("halves").alias("h"))
    rest = halves.select(
        "at", F.col("h.half").alias("half"), F.col("h.kind").alias("kind"),
        F.expr(
            """case h.kind when 0 then substring(line, n div 2 + 1) when 1 then substring(line, 1, n div 2)
                 when 2 then substring(line, (n - 1) div 2 + 1) else substring(line, 1, (n - 1) div 2 + 1) end"""
        ).alias("rest"),
    )
    deleted = "concat(substring(rest, 1, i - 1), substring(rest, i + 1))"
    keys = F.expr(
        f"""case when kind < 2 then concat(
              transform(sequence(1, char_length(rest)),
                        i -> named_struct('key', xxhash64('s', half, i, {deleted}), 'role', 's')),
              array(named_struct('key', xxhash64('w', half, rest), 'role', 'w')))
            else transform(sequence(1, char_length(rest)),
                           i -> named_struct('key', xxhash64('w', half, {deleted}), 'role', 'd')) end"""
    )
    return rest.select("at", F.explode(keys).alias("v")).select("v.key", "v.role", "at")


def near_lines(texts: DataFrame) -> DataFrame:
    """The places of lines that have an earlier one within one edit."""
    emitted = variants(texts)
    first = lambda role: F.min(F.when(F.col("role") == role, F.col("at")))
    groups = emitted.groupBy("key").agg(
        F.count("*").alias("n"), first("s").alias("s"), first("w").alias("w"), first("d").alias("d")
    ).filter("n > 1").drop("n")
    partner = F.when(F.col("role") == "s", F.col("s")).when(F.col("role") == "d", F.col("w")).otherwise(F.col("d"))
    pairs = emitted.join(shuffled(groups), "key").select("at", partner.alias("other")).filter("other < at").distinct()
    line, other = texts.select(_at().alias("at"), "line"), texts.select(_at().alias("other"), F.col("line").alias("earlier"))
    both = pairs.join(shuffled(line), "at").join(shuffled(other), "other")
    verified = both.filter(F.levenshtein("line", "earlier", 1).between(0, 1))
    return verified.select("at").distinct()


def segment_keys(chars_per_edit: int, max_edits: int) -> tuple[Column, Column]:
    """Hashed segments of a line of n characters, and the substrings that can be a segment of a line not longer."""
    bound = lambda n: f"least({max_edits}, ({n}) div {chars_per_edit})"

    def segment(n: str) -> tuple[str, str, str]:  # edits, start and size of segment i of a line of n characters
        k = bound(n)
        start = f"((i * ({n})) div ({k} + 1))"
        return k, start, f"(((i + 1) * ({n})) div ({k} + 1) - {start})"

    k, start, size = segment("n")
    own = F.expr(f"transform(sequence(0, {k}), i -> xxhash64(n, i, substring(line, {start} + 1, {size})))")
    k, start, size = segment("n - d")
    places = (f"sequence(greatest(0, {start} - i, {start} + d - ({k} - i)), "
              f"least(n - {size}, {start} + i, {start} + d + ({k} - i)))")
    hashes = f"transform({places}, p -> xxhash64(n - d, i, substring(line, p + 1, {size})))"
    lengths = f"filter(sequence(0, {max_edits}), d -> {k} >= 2 and d <= {k})"
    return own, F.expr(f"flatten(transform({lengths}, d -> flatten(transform(sequence(0, {k}), i -> {hashes}))))")


def near_long_lines(lines: DataFrame, min_near_chars: int, chars_per_edit: int, max_edits: int) -> DataFrame:
    """The places of lines that have an earlier one within a bound of two edits or more."""
    least = max(min_near_chars, 2 * chars_per_edit)
    sized = lines.select(_at().alias("at"), "line", F.char_length("line").alias("n")).filter(F.col("n") >= least)
    firsts = staged(sized.groupBy("line", "n").agg(F.min("at").alias("at")), "long-lines")
    own, others = segment_keys(chars_per_edit, max_edits)
    segments = firsts.select(F.explode(own).alias("key"), F.col("at").alias("a"))
    parts = firsts.select(F.explode(F.array_distinct(others)).alias("key"), F.col("at").alias("b"))
    pairs = segments.join(shuffled(parts), "key").filter("a <> b")
    pairs = pairs.select(F.greatest("a", "b").alias("at"), F.least("a", "b").alias("other")).distinct()
    earlier = firsts.select(F.col("at").alias("other"), F.col("line").alias("earlier"), F.col("n").alias("m"))
    bound = f"cast(least({max_edits}, least(n, m) div {chars_per_edit}) as int)"
    both = pairs.join(shuffled(firsts), "at").join(shuffled(earlier), "other")
    verified = both.filter(F.expr(f"levenshtein(line, earlier, {bound}) >= 0"))
    return verified.select("at").distinct()


def dedup_lines(docs: DataFrame, *, min_near_chars: int = MIN_NEAR_CHARS, chars_per_edit: int | None = None,
                max_edits: int = MAX_EDITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (without the lines that go), n_lines, n_removed, n_blank, row (the input row) for every row."""
    docs = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), F.xxhash64(col(text_col)).alias("tie"),
                       F.struct(*map(col, docs.columns)).alias("row"))
    lines = split_lines(docs)
    firsts = staged(first_lines(lines, min_near_chars), "first-lines")
    found = staged(candidates(firsts), "line-candidates")
    texts = staged(candidate_texts(docs, found), "candidate-lines")
    near = near_lines(texts)
    if chars_per_edit and max_edits > 1:
        near = near.unionAll(near_long_lines(lines, min_near_chars, chars_per_edit, max_edits))
    hashed = lines.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), _at().alias("at"))
    repeated = firsts.filter("copies > 1").select("h1", "h2", "first")
    copies = hashed.join(shuffled(repeated), ["h1", "h2"]).filter("at <> first")
    gone = staged(copies.select("at.*").unionAll(near.select("at.*")), "gone-lines")
    gone = gone.groupBy("doc_id", "tie").agg(F.collect_set("line_no").alias("gone"))
    joined = docs.join(
        shuffled(gone), docs["doc_id"].eqNullSafe(gone["doc_id"]) & (docs["tie"] == gone["tie"]), "left"
    ).select(docs["doc_id"], docs["text"], docs["row"], gone["gone"])
    every = joined.withColumn("line", F.split("text", "\n"))
    kept = F.expr("transform(array_except(sequence(0, size(line) - 1), gone), i -> line[i])")
    every = every.withColumn("kept", F.when(F.col("gone").isNull(), F.col("line")).otherwise(kept))
    blank = F.expr("size(filter(kept, x -> btrim(x, ' \\t\\r') = ''))")
    count = lambda c: F.when(F.col("text").isNull(), 0).otherwise(F.size(c))
    return every.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
        count("line").alias("n_lines"), (count("line") - count("kept")).alias("n_removed"),
        F.when(F.col("text").isNull(), 0).otherwise(blank).alias("n_blank"),
        "row",
    )
