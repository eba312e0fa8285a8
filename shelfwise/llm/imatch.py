"""I-Match fingerprints: hashes of the terms that random lexicons leave of a text.

Texts are lower-cased; terms are their runs of letters, digits and non-ASCII characters. Only
terms of a band of inverse document frequency count: between one row in ``COMMON`` and one in
``RARE`` holds them. Of the band, ``DRAWS`` x ``len(RATES)`` random lexicons keep a share each, drawn
by a hash of the term; small shares serve long texts, large ones short texts. A signature is the
hash of a text's distinct terms in one lexicon, sorted by their codes. The fingerprint is all
signatures in order, ``NONE`` where a lexicon keeps no term of the text. A text of which no lexicon
keeps a term has the hash of itself in every place.

Two fingerprints are alike by the share of equal signatures among those not empty in both. For one
lexicon that is an estimate of the share of terms that two texts have in common.

The band holds at most (mean distinct terms of a row) x ``RARE`` terms, however many rows there are;
it is broadcast while its size allows it and else joined by a shuffle. Terms are added up before
they are shuffled. What is gathered per text are the codes of its own terms.

``edited`` texts need an order of documents: by id, descending, null last, then by a hash of the
text. Rows equal in id and text are one document in it: they are worked on once, and repeated in the
result. Null text is empty. Only the id and the text are read. A table of one document is its own
neighbour; an empty one gives an empty result. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import repeated
from shelfwise.operators.joins import small_side
from shelfwise.operators.matrix import dense_index
from shelfwise.session import materialize

COMMON, RARE = 50, 2000
DRAWS = 16
# Shares of the band: a number of three hexadecimal digits must stay below these, of 4,096.
RATES = [128, 32, 8, 2]
# Characters of a signature.
WIDTH = 6
NONE = "-" * WIDTH
# A code has the lexicon's draw, the term's depth in it and 24 bits of the term's hash.
DRAW_BITS, DEPTH_BITS = 26, 24

KEY = ["_id", "_t1", "_t2"]
TERM_END = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """The distinct terms of a text, and the empty one."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(text), TERM_END)))


def term_keys(text: Column) -> Column:
    """The same as 64-bit hashes, which are told apart and joined faster."""
    parts = F.concat(F.array(F.lit("")), F.split(F.lower(text), TERM_END))
    return F.array_distinct(F.transform(parts, lambda x: F.xxhash64(x)))


def codes(term: Column) -> Column:
    """One code for each draw in which a term is kept, at its smallest share."""
    digits = F.sha2(term, 256)
    number = lambda at, n: F.conv(F.substring(digits, at, n), 16, 10).cast("int")
    own = number(3 * DRAWS + 1, 6)
    kept = []
    for draw in range(DRAWS):
        value = number(3 * draw + 1, 3)
        depth = sum(((value < rate).cast("int") for rate in RATES[1:]), F.lit(draw << DRAW_BITS - DEPTH_BITS))
        kept.append(F.when(value < RATES[0], F.shiftleft(depth, DEPTH_BITS).bitwiseOR(own)))
    return F.array_compact(F.array(*kept))


def band(rows: DataFrame, common: int, rare: int) -> DataFrame:
    """(_term, codes): hashes of the terms in the band that some lexicon keeps, written.

    The empty term has an empty code, so that no text is lost in a join.
    """
    n = F.lit(rows.count())
    # An outer explode, as the planner would part the texts twice to filter for an inner one.
    held = rows.select(F.explode_outer(terms(F.col("text"))).alias("term")).filter("term != ''")
    held = held.groupBy("term").agg(F.count(F.lit(1)).alias("_rows"))
    held = held.filter((F.col("_rows") * common <= n) & (F.col("_rows") * rare >= n))
    # Written, as the planner would ask for the codes of every term before it counts.
    held = materialize(held.select("term"), "counted")
    kept = held.select("term", codes(F.col("term")).alias("codes")).filter(F.size("codes") > 0)
    none = rows.sparkSession.range(1).select(F.lit("").alias("term"), F.array(F.lit(-1)).alias("codes"))
    return materialize(kept.unionByName(none).select(F.xxhash64("term").alias("_term"), "codes"), "band")


def fingerprint(held: Column, text_hash: Column) -> Column:
    """From the codes of a text, sorted."""
    # The codes of one draw are a stretch of the sorted ones, those of one depth its end.
    draws = F.array(*[F.lit(draw << DRAW_BITS) for draw in range(DRAWS)])
    depths = F.array(*[F.lit(depth << DEPTH_BITS) for depth in range(len(RATES))])

    def signature(left: Column) -> Column:
        written = F.array_join(left.cast("array<string>"), ",")
        return F.when(written != "", F.substring(F.md5(written.cast("binary")), 1, WIDTH)).otherwise(NONE)

    def of_draw(draw: Column) -> Column:
        own = F.filter(held, lambda x: (x >= draw) & (x - draw < 1 << DRAW_BITS))
        # An array of one, so that the stretch is cut out once for all depths.
        return F.element_at(F.transform(F.array(own), lambda codes: F.transform(
            depths, lambda depth: signature(F.filter(codes, lambda x: x - draw >= depth))
        )), 1)

    whole = F.repeat(F.substring(text_hash, 1, WIDTH), F.lit(DRAWS * len(RATES)))
    return F.when(F.element_at(held, -1) >= 0, F.array_join(F.flatten(F.transform(draws, of_draw)), "")).otherwise(whole)


def likeness(left: Column, right: Column) -> Column:
    """The share of equal signatures among those not empty in both; 1 if all are empty."""
    places = F.array(*[F.lit(i * WIDTH + 1) for i in range(DRAWS * len(RATES))])
    none = F.lit(NONE.encode())
    # Bytes are cut anywhere at once, where text is read from its start.
    at = lambda text, i: F.substr(text.cast("binary"), i, F.lit(WIDTH))
    both = F.filter(places, lambda i: (at(left, i) == none) & (at(right, i) == none))
    same = F.filter(places, lambda i: at(left, i) == at(right, i))
    some = F.size(places) - F.size(both)
    return F.when(some > 0, (F.size(same) - F.size(both)) / some).otherwise(F.lit(1.0))


def keyed(documents: DataFrame, id_column: str) -> DataFrame:
    rows = documents.select(F.col(id_column).alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumns({"_t1": F.xxhash64("text"), "_t2": F.xxhash64(F.lit(1), "text")})


def neighbours(rows: DataFrame) -> DataFrame:
    """One row per document: its key, how often it stands in the table, and the key of the next."""
    once = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_rows"), F.first(F.char_length("text")).alias("_chars"))
    order = [F.desc_nulls_last("_id"), "_t1", "_t2"]
    placed = materialize(dense_index(materialize(once, "once"), order, "_at", "bigint"), "placed")
    n = placed.count()
    following = placed.select(
        F.pmod(F.col("_at") - 1, F.lit(max(n, 1))).alias("_at"), *[F.col(x).alias(f"_next{x}") for x in KEY],
        F.col("_rows").alias("_next_rows"),
    )
    return materialize(placed.join(following, "_at").drop("_at"), "neighbours")


def same_key(left: list[str], right: list[str]) -> Column:
    found = F.lit(True)
    for a, b in zip(left, right):
        found = found & F.col(a).eqNullSafe(F.col(b))
    return found


def edited_texts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document its key, ``text`` and ``edited``: the last third replaced by the next one's start."""
    need = F.floor(F.col("_chars") / 3).cast("int")
    names = [f"_next{x}" for x in KEY]
    asked = small_side(pairs.select(*[F.col(x).alias(f"_for{x}") for x in KEY], *names, "_next_rows", need.alias("_need")))
    starts = rows.join(asked, same_key(KEY, names)).select(
        *[f"_for{x}" for x in KEY], "_next_rows", F.substr("text", F.lit(1), "_need").alias("_start")
    )
    # A document on several rows would answer several times.
    once = starts.filter("_next_rows = 1").drop("_next_rows")
    more = starts.filter("_next_rows > 1").groupBy(*[f"_for{x}" for x in KEY]).agg(F.first("_start").alias("_start"))
    both = rows.join(once.unionByName(more), same_key(KEY, [f"_for{x}" for x in KEY]))
    n = F.char_length("text")
    head = F.substr("text", F.lit(1), n - F.floor(n / 3).cast("int"))
    return both.select(*KEY, "text", F.concat(head, "_start").alias("edited"))


def fingerprints(documents: DataFrame, id_column: str = "doc_id", common: int = COMMON, rare: int = RARE) -> DataFrame:
    """One row per document: ``n_chars``, the SHA-256 of its edited text, the fingerprints of the
    text and of the edited text, and how alike the first is to the second and to the next
    document's."""
    rows = keyed(documents, id_column)
    lexicon = small_side(band(rows, common, rare))
    pairs = neighbours(rows)
    texts = edited_texts(rows, pairs)
    both = F.concat(
        F.transform(term_keys(F.col("text")), lambda x: F.struct(x.alias("_term"), F.lit(False).alias("_new"))),
        F.transform(term_keys(F.col("edited")), lambda x: F.struct(x.alias("_term"), F.lit(True).alias("_new"))),
    )
    carried = ["edited_sha256", "_text", "_edited"]
    hashes = [
        F.sha2("edited", 256).alias("edited_sha256"),
        *[F.substring(F.md5(F.col(x).cast("binary")), 1, WIDTH).alias(f"_{x}") for x in ("text", "edited")],
    ]
    # The hashes are taken before the terms make many rows of one.
    held = texts.select(*KEY, *hashes, both.alias("_both")).select(*KEY, *carried, F.inline_outer("_both"))
    held = held.join(lexicon, "_term").select(*KEY, *carried, "_new", F.explode_outer("codes").alias("_code"))
    held = held.groupBy(*KEY, *carried).agg(
        F.sort_array(F.collect_set(F.when(~F.col("_new"), F.col("_code")))).alias("_own"),
        F.sort_array(F.collect_set(F.when(F.col("_new"), F.col("_code")))).alias("_changed"),
    )
    found = materialize(held.select(
        *KEY, "edited_sha256",
        fingerprint(F.col("_own"), F.col("_text")).alias("fingerprint"),
        fingerprint(F.col("_changed"), F.col("_edited")).alias("edited_fingerprint"),
    ), "fingerprints")

    names = [f"_next{x}" for x in KEY]
    following = found.select(*[F.col(x).alias(y) for x, y in zip(KEY, names)], F.col("fingerprint").alias("_following"))
    links = small_side(pairs.toDF(*[f"_of{x}" if x in KEY else x for x in pairs.columns]))
    result = found.join(links, same_key(KEY, [f"_of{x}" for x in KEY])).drop(*[f"_of{x}" for x in KEY])
    asked = result.toDF(*[f"_asked{x}" if x in names else x for x in result.columns])
    result = asked.join(following, same_key([f"_asked{x}" for x in names], names))
    result = result.select(
        F.col("_id").alias(id_column), F.col("_chars").cast("long").alias("n_chars"), "edited_sha256",
        "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_following")).alias("near_next"), "_rows",
    )
    return repeated(result, "_rows")

