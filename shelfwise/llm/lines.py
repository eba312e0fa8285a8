"""Removal of cross-site boilerplate lines, found by the spread of each line over sites.

Every line that is not blank gets a HyperLogLog sketch of the sites it stands on; sketches of one
line merge by aggregation. An estimate well above ``sites`` makes a line boilerplate, one well
below does not, and lines in between get an exact count of distinct sites. Boilerplate lines leave
their documents, whatever their share. A document is left whole only if no other line would stay,
or if its text stands on several rows: a copy's lines are on many sites because the text is, and
near-duplicate removal judges it. ``edited`` also leaves texts whole that are shown to be near
copies of one other text (``near_copies``).

Lines are parted by ``\\n`` and compared whole, by two 64-bit hashes. Null text is kept as null and
has no lines. A null site counts for no line. Rows are edited where they stand: repeated rows are
edited alike, all columns and rows stay whatever their names, and an empty table gives an empty one.

All steps are DataFrame functions. One line on a third of all rows is summed before the shuffle;
the boilerplate lines are written once and joined, by broadcast while their size allows it. Texts without any stay where they are, the others are
shuffled to their cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import small_side
from shelfwise.session import materialize

LINE = ["_h1", "_h2"]
TEXT = ["_t1", "_t2"]
# Standard errors around the threshold within which a line is counted exactly.
MARGIN = 4
# A near copy has this share of its characters in common with another text.
ALIKE = 0.8
# A text with more boilerplate than this share of its lines may be a near copy.
MOSTLY = 0.5
# So many boilerplate lines at most are looked up beside each text, as numbers of the plan.
MOST_LOOKED_UP = 20_000
# A line in one number: the low bits hold its length, the others a hash.
LENGTH_BITS = 24


def lines_of(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def not_blank(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]"))


def hashes(line: Column | str) -> list[Column]:
    line = F.col(line) if isinstance(line, str) else line
    return [F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line).alias("_h2")]


def nested(documents: DataFrame, site: str) -> DataFrame:
    """``_row`` with all columns, the text and the site: no column of the input can clash."""
    whole = F.struct(*[F.col(f"`{name}`") for name in documents.columns])
    return documents.select(whole.alias("_row"), F.col("text"), F.col(f"`{site}`").alias("_site"))


def boilerplate(rows: DataFrame, sites: int, lg_k: int = 10) -> DataFrame:
    """The hashes of lines on at least ``sites`` distinct sites, written to the shared folder."""
    line = F.explode(lines_of("text")).alias("_line")
    rows = rows.filter(F.col("_site").isNotNull()).select("_site", line)
    rows = rows.filter(not_blank(F.col("_line"))).select(*hashes("_line"), "_site")
    spread = rows.groupBy(*LINE).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(lg_k))).alias("_spread")
    )
    error = 1.04 / 2 ** (lg_k / 2)
    low, high = sites * (1 - MARGIN * error) - 1, sites * (1 + MARGIN * error) + 1
    # Most lines stand on one site; what is left is small beside the input.
    near = materialize(spread.filter(F.col("_spread") >= low), "spread")
    unsure = near.filter(F.col("_spread") <= high).select(*LINE)
    exact = rows.join(small_side(unsure), LINE, "left_semi").distinct().groupBy(*LINE).count()
    certain = near.filter(F.col("_spread") > high).select(*LINE)
    found = certain.unionByName(exact.filter(F.col("count") >= sites).select(*LINE))
    return materialize(found, "boilerplate")


def text_key() -> list[Column]:
    return [F.xxhash64("text").alias("_t1"), F.xxhash64(F.lit(1), "text").alias("_t2")]


def n_lines() -> Column:
    lines = F.size(F.filter(lines_of("text"), not_blank))
    return F.when(F.col("text").isNull(), 0).otherwise(lines)


def near_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Keys of the texts, among those that are mostly boilerplate, that are near copies of one more.

    Every line names the longest text that holds it, among texts of about one length. A text is a
    near copy if a text that one of its lines names holds ``ALIKE`` of its characters, by distinct
    lines; the named one is, if that holds the other way round. Texts of about one length share a
    class of length: each is in two, its own and the next. A text is compared with the texts that
    its lines name and no others, so comparisons grow with the lines, however many texts share one.
    """
    heavy = cuts.filter(
        (F.col("_rows") == 1) & (F.col("_found") > MOSTLY * F.col("_lines")) & (F.col("_found") < F.col("_lines"))
    )
    heavy = materialize(heavy.select(*TEXT), "heavy")
    longest = 2**LENGTH_BITS - 1
    packed = F.transform(
        F.filter(lines_of("text"), not_blank),
        lambda x: F.shiftleft(F.xxhash64(x), LENGTH_BITS).bitwiseOR(
            F.least(F.length(x), F.lit(longest)).cast("long")
        ),
    )
    size = lambda line: line.bitwiseAND(F.lit(longest).cast("long"))
    total = lambda column: F.aggregate(column, F.lit(0).cast("long"), lambda n, x: n + size(x))
    texts = rows.select(*text_key(), "text").join(small_side(heavy), TEXT, "left_semi")
    texts = texts.select(*TEXT, F.array_distinct(packed).alias("_all"))
    texts = materialize(texts.withColumn("_chars", total("_all")), "heavy-lines")

    # Texts that are alike are at most one class apart, so they meet in one of their two.
    step = F.floor(F.log(F.col("_chars").cast("double")) / F.log(F.lit(1 / ALIKE)))
    held = texts.withColumn("_class", F.explode(F.array(step, step + 1)))
    held = held.select(*TEXT, "_class", "_chars", F.explode("_all").alias("_line"))
    hubs = held.groupBy("_class", "_line").agg(
        F.max(F.struct("_chars", *TEXT)).alias("_hub"), F.count(F.lit(1)).alias("_holders")
    )
    hubs = materialize(hubs.filter(F.col("_holders") > 1).drop("_holders"), "hubs")
    named = held.join(small_side(hubs), ["_class", "_line"])
    hub = [F.col("_hub._t1").alias("_u1"), F.col("_hub._t2").alias("_u2")]
    named = named.select(*TEXT, *hub)
    named = named.filter((F.col("_t1") != F.col("_u1")) | (F.col("_t2") != F.col("_u2")))
    pairs = named.select(*TEXT, "_u1", "_u2")
    pairs = materialize(pairs.distinct(), "pairs")
    other = texts.toDF("_u1", "_u2", "_other", "_more")
    both = pairs.join(texts, TEXT).join(other, ["_u1", "_u2"])
    common = total(F.array_intersect("_all", "_other"))
    both = both.select(*TEXT, "_u1", "_u2", "_chars", "_more", common.alias("_common"))
    here = both.filter(F.col("_common") >= ALIKE * F.col("_chars")).select(*TEXT)
    there = both.filter(F.col("_common") >= ALIKE * F.col("_more")).select(F.col("_u1").alias("_t1"), F.col("_u2").alias("_t2"))
    shown = here.unionByName(there)
    return materialize(shown.distinct(), "copies")


def touched(spread: DataFrame) -> Column | None:
    """Whether a text may hold a line of ``spread``, or None if these are too many to look up beside it."""
    found = spread.select("_h1").distinct()
    if found.count() > MOST_LOOKED_UP:
        return None
    # As text: the planner makes one hash set of the numbers.
    known = ", ".join(f"{row._h1}L" for row in found.collect()) or "NULL"
    return F.expr(rf"coalesce(exists(split(text, '\n', -1), line -> xxhash64(line) IN ({known})), false)")


def removed_lines(
    documents: DataFrame, site: str = "source", sites: int = 10, spare_near_copies: bool = False
) -> DataFrame:
    """Per document ``_row`` with all its columns, ``_lines`` (those not blank), ``_found``
    (boilerplate among them), ``_cut`` (those that leave) and ``_kept``, the text that stays."""
    rows = nested(documents, site)
    spread = boilerplate(rows, sites)
    # Positions of boilerplate lines, for each distinct text that has some, and its rows.
    # Keys and counts are taken before the lines make many rows of one.
    texts = rows.select(*text_key(), n_lines().alias("_lines"), lines_of("text").alias("_parts"))
    texts = texts.select(*TEXT, "_lines", F.posexplode("_parts").alias("_at", "_line"))
    lines = texts.filter(not_blank(F.col("_line"))).select(*TEXT, "_lines", "_at", *hashes("_line"))
    hits = lines.join(small_side(spread), LINE, "left_semi")
    cuts = hits.groupBy(*TEXT, "_lines").agg(F.collect_set("_at").alias("_places"), F.count(F.lit(1)).alias("_hits"))
    found = F.size("_places")
    cuts = materialize(cuts.select(*TEXT, "_lines", "_places", found.alias("_found"), (F.col("_hits") / found).alias("_rows")), "cuts")
    spared = (F.col("_found") == F.col("_lines")) | (F.col("_rows") > 1)
    if spare_near_copies:
        marks = small_side(near_copies(rows, cuts)).withColumn("_near", F.lit(True))
        cuts = materialize(cuts.join(marks, TEXT, "left"), "marked-cuts")
        spared = spared | F.col("_near").isNotNull()
    cuts = cuts.select(*TEXT, "_places", "_found", F.when(spared, 0).otherwise(F.col("_found")).alias("_cut"))
    # Only texts that may hold boilerplate travel to their cuts; the others are whole where they stand.
    marked, may_hold = rows, touched(spread)
    if may_hold is not None:
        marked = rows.withColumn("_may", may_hold)
        rows = marked.filter("_may").drop("_may")
    edited = rows.withColumns(dict(zip(TEXT, text_key()))).join(cuts, TEXT, "left")
    if may_hold is not None:
        edited = edited.unionByName(marked.filter("NOT _may").drop("_may"), allowMissingColumns=True)
    stays = F.filter(lines_of("text"), lambda line, at: ~F.array_contains("_places", at))
    cut = F.coalesce("_cut", F.lit(0))
    return edited.select(
        "_row", n_lines().alias("_lines"), F.coalesce("_found", F.lit(0)).alias("_found"), cut.alias("_cut"),
        F.when(cut == 0, F.col("text")).otherwise(F.array_join(stays, "\n")).alias("_kept"),
    )


def digest(documents: DataFrame, id_column: str = "doc_id", site: str = "source", sites: int = 10) -> DataFrame:
    """One row per document: lines that are not blank, those removed, those that were boilerplate,
    and the SHA-256 of the text that stays (null: the empty text)."""
    rows = removed_lines(documents.select(id_column, "text", site), site, sites)
    return rows.select(
        F.col(f"_row.{id_column}").alias(id_column),
        F.col("_lines").cast("long").alias("n_lines"),
        F.col("_found").cast("long").alias("n_boilerplate"),
        F.col("_cut").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("_kept", F.lit("")), 256).alias("kept_sha256"),
    )


def edited(documents: DataFrame, **options) -> DataFrame:
    """The documents with boilerplate lines removed from ``text``; all else as it was."""
    rows = removed_lines(documents, spare_near_copies=True, **options)
    return rows.select(*[
        F.col("_kept").alias(name) if name == "text" else F.col(f"_row.`{name}`").alias(name)
        for name in documents.columns
    ])
