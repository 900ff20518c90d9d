"""Recurring lines, found through a tree of log templates.

The tree has a fixed depth: a line goes by its number of tokens and its leading tokens, with
those that hold digits read as variable, to a leaf. A leaf has several templates. Each is a line
that stands for those alike: they have the same token at enough places, and not in the opening
only, which all lines of the leaf share. Variable fields agree with nothing. Templates met in
enough documents are boilerplate, and so is each line that is in as many by itself. A long line
that stands word for word in two documents is, too.

Like lines are found by bands: the places after the opening are cut into one band more than the
number of places at which like lines may differ, so they share a whole band. In each group of
lines that share one or two adjacent bands, the line of most documents speaks for the others first:
where many lines are alike, the work grows with the lines and not with their pairs. A line that finds
no template so is compared with every line it shares a band with, and what may be its template with
every line that shares one with that; so a line stays only if none it is like recurs.

Everything is built-in expressions and joins. Only lines in leaves that enough documents share
are ever compared by tokens, and equal lines are counted before they are; the text itself is
shuffled once, to put the remaining lines together with the rows they came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import fresh, quoted, with_columns
from sightlake.operators.joins import lookup_join
from sightlake.session import broadcast_if_small, drop_staged, stage

FIELD = "<*>"
LEADING_TOKENS = 3
MIN_DOCUMENTS = 6
SIMILARITY = 0.7
#: A line of so many tokens, repeated word for word, is no chance: two documents are enough.
LONG_TOKENS = 20
#: A band with more lines is spread: a task compares so many of them with those that ask.
COMPARED = 10_000


def _single_blanks(text: Column) -> Column:
    """A text whose lines have single blanks between their tokens; few texts have anything else."""
    other = r"[\x00-\x09\x0B-\x1F][\x00-\x09\x0B-\x20]*| [\x00-\x09\x0B-\x20]+"
    return F.when(text.rlike(other), F.regexp_replace(text, other, " ")).otherwise(text)


def _masked(single: Column) -> Column:
    """Tokens with digits as variable fields; a token is looked through once."""
    return F.when(single.rlike("[0-9]"), F.regexp_replace(
        single, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)).otherwise(single)


def _name(line: Column) -> Column:
    """What a line goes by: 128 bits, so that of 10^12 lines no two are likely to share a name."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _n_tokens(masked: Column) -> Column:
    return F.length(masked) - F.length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def _leaf(masked: Column) -> Column:
    return F.xxhash64(_n_tokens(masked), F.substring_index(masked, " ", LEADING_TOKENS))


def _lines(df: DataFrame, column: str) -> DataFrame:
    """(place, line_no, single, masked) for every line with a token; places follow the table."""
    numbered = df.select(
        F.monotonically_increasing_id().alias("place"), F.col(quoted(column)).alias("text"))
    lines = numbered.select("place", F.posexplode(
        F.split(_single_blanks(F.col("text")), "\n")).alias("line_no", "line"))
    single = lines.select("place", "line_no", F.trim("line").alias("single")).where("single <> ''")
    return single.withColumn("masked", _masked(F.col("single")))


def _join_counted(rows: DataFrame, right: DataFrame, key, how: str = "inner") -> DataFrame:
    """A join that broadcasts the right side only where its measured size allows it."""
    right, _ = broadcast_if_small(right)
    return rows.join(right, key, how)


def _needed(n: Column, similarity: float) -> Column:
    """Places of n at which like lines agree, at least."""
    return F.ceil(n * F.lit(similarity) - F.lit(1e-9)).cast("int")


def _band_keys(distinct: DataFrame, similarity: float) -> DataFrame:
    """Keys of each line's bands and of adjacent two: lines alike enough share the key of a band.

    Fields agree with nothing, so a band with one in it is not among those that must be shared. Those
    that share two share one: ``wide`` tells their keys.
    """
    # Columns of their own, or each band would split the line again.
    tokens, n = F.col("tokens"), F.size("tokens")
    cut = distinct.select("leaf", "line", "n", "recurs", F.split("masked", " ").alias("tokens"))
    cut = cut.select("*", F.least(
        n - LEADING_TOKENS, n - _needed(n, similarity) + 1).alias("bands")).select(
        "leaf", "line", "n", "recurs", "tokens", "bands",
        F.explode(F.sequence(F.lit(0), F.col("bands") - 1)).alias("first"))
    rest = n - LEADING_TOKENS

    def key(wide):
        a = F.floor(F.col("first") * rest / F.col("bands")).cast("int")
        b = F.floor((F.col("first") + wide) * rest / F.col("bands")).cast("int")
        band = F.slice(tokens, a + LEADING_TOKENS + 1, b - a)
        inside = (F.col("first") + wide <= F.col("bands")) & (
            (F.lit(wide) == 1) | (F.col("bands") > 2))
        return F.when(inside & ~F.array_contains(band, FIELD), F.struct(
            F.xxhash64("leaf", "first", F.lit(wide), band).alias("key"), F.lit(wide).alias("wide")))

    return cut.select("line", "n", "recurs", F.explode(F.array_compact(
        F.array(key(1), key(2)))).alias("k")).select("line", "n", "recurs", "k.key", "k.wide")


def _alike(own: Column, other: Column, similarity: float) -> Column:
    """Whether two lines of a leaf have the same tokens at enough places, some after the opening."""
    same = F.zip_with(F.split(own, " "), F.split(other, " "), lambda a, b: (a == b) & (a != FIELD))
    count = lambda flags: F.size(F.filter(flags, lambda x: x))
    n = F.size(same)
    return (count(same) >= _needed(n, similarity)) & (
        count(F.slice(same, LEADING_TOKENS + 1, F.greatest(n, F.lit(1)))) > 0)


def _spoken(keys: DataFrame) -> DataFrame:
    """(line, template): lines that do not recur by themselves, and those that speak for their groups.

    For each group, its commonest line and the commonest that does not recur by itself speak, so a
    hot line hides no others.
    """
    voice = F.struct("n", "line")
    spoken = keys.groupBy("key").agg(
        F.count("*").alias("lines"), F.max(F.when(F.col("recurs"), voice)).alias("hot"),
        F.max(F.when(~F.col("recurs"), voice)).alias("own")).where("lines > 1")
    spoken = stage(spoken.select("key", F.array_compact(
        F.array("hot.line", "own.line")).alias("templates")), "spoken")
    return _join_counted(keys.where(~F.col("recurs")), spoken, "key").select(
        "line", F.explode("templates").alias("template")).distinct()


def _neighbours(keys: DataFrame, lines: DataFrame) -> DataFrame:
    """(line, template): some lines, and every one that they share a band with, themselves too."""
    bands = keys.where("wide = 1")
    own = stage(_join_counted(bands.select("line", "key"), lines, "line", "left_semi"), "own_keys")
    return lookup_join(
        bands.select("key", F.col("line").alias("template")), own, ["key"], "inner",
        hot_rows=COMPARED).select("line", "template").distinct()


def _like(pairs: DataFrame, distinct: DataFrame, similarity: float) -> DataFrame:
    """(line, template, recurs) of the pairs that are alike; staged. ``recurs`` is the template's.

    ``distinct`` has (leaf, line, masked, n, recurs).
    """
    asked = stage(pairs, "asked")
    speakers = _join_counted(
        distinct.select(F.col("line").alias("template"), F.col("masked").alias("said"), "recurs"),
        asked.select("template").distinct(), "template", "left_semi")
    with_own = _join_counted(asked, distinct.select("line", "masked"), "line")
    both = _join_counted(with_own, speakers, "template")
    found = stage(both.where(_alike(F.col("masked"), F.col("said"), similarity)).select(
        "line", "template", "recurs"), "likenesses")
    drop_staged(distinct.sparkSession, asked)
    return found


def _chosen(like: DataFrame, rows: DataFrame) -> DataFrame:
    """(line, template): of what a line is like, one that recurs by itself, else by most rows; staged.

    ``rows`` has (template, rows) for templates in enough rows.
    """
    return stage(_join_counted(like, stage(rows, "rows"), "template", "left").where(
        F.col("recurs") | F.col("rows").isNotNull()).groupBy("line").agg(
        F.max(F.struct("recurs", "rows", "template")).alias("best")).select(
        "line", F.col("best.template").alias("template")), "chosen")


def _belonging(
    distinct: DataFrame, thin: DataFrame, min_documents: int, similarity: float,
) -> DataFrame:
    """(line, template) of lines that do not recur by themselves and are like a template; staged.

    Lines that speak are asked first. Lines that are like none of them, or only such as do not
    recur, are compared with all that share a band; of those that do not recur by themselves, what
    is like them is looked for in the same way, since their rows decide.
    """
    def in_rows(like: DataFrame) -> DataFrame:
        return _join_counted(thin.select("line", "place"), like, "line").select(
            "template", "place").distinct().groupBy("template").agg(
            F.count("*").alias("rows")).where(F.col("rows") >= min_documents)

    keys = stage(_band_keys(distinct, similarity), "keys")
    like = _like(_spoken(keys), distinct, similarity)
    chosen = _chosen(like, in_rows(like.where("not recurs").select("line", "template")))
    left = stage(_join_counted(
        distinct.where(~F.col("recurs")).select("line"), chosen.select("line"), "line", "left_anti"), "left")
    near = _like(_neighbours(keys, left), distinct, similarity)
    sure = near.where("recurs").select("line").distinct()
    asked = stage(_join_counted(near, stage(sure, "sure"), "line", "left_anti").select(
        F.col("template").alias("line")).distinct(), "asked_for")
    around = _like(_neighbours(keys, asked), distinct, similarity).where("not recurs").select(
        F.col("template").alias("line"), F.col("line").alias("template"))
    late = _chosen(near, in_rows(around))
    drop_staged(distinct.sparkSession, keys, like, left, near, asked)
    return chosen.unionByName(late)


def templates(df: DataFrame, column: str = "text", min_documents: int = MIN_DOCUMENTS,
              similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Recurring templates, and the lines that belong to them.

    The first has (template, wording, n_documents, first_place), the second (place, line_no,
    template); a template goes by its line's name, and its wording has the tokens that all its lines
    share, and ``<*>`` where they differ. A template recurs if at least ``min_documents`` different
    rows of df hold a line of it; a line belongs to one template: itself if it recurs, or a line
    with the same token at ``similarity`` of its places. Copies of a document count as documents.
    """
    found, belongs = _recurring(df, column, min_documents, similarity)
    lines = belongs.join(_lines(df, column).select("place", "line_no", "single"), ["place", "line_no"])
    tokens = lines.select("template", "single").distinct().select(
        "template", F.posexplode(F.split("single", " ")).alias("at", "token"))
    agreed = tokens.groupBy("template", "at").agg(
        F.when(F.min("token") == F.max("token"), F.min("token")).otherwise(FIELD).alias("token"))
    wording = agreed.groupBy("template").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "token"))), lambda t: t["token"]), " ").alias("wording"))
    return found.join(wording, "template").select(
        "template", "wording", "n_documents", "first_place"), belongs


def _recurring(
    df: DataFrame, column: str, min_documents: int, similarity: float,
) -> tuple[DataFrame, DataFrame]:
    """(template, n_documents, first_place), and (place, line_no, template), both staged."""
    lines = _lines(df, column)
    masked = F.col("masked")
    # One narrow row for each line: what is counted and joined from here on.
    thin = stage(lines.select(
        "place", "line_no", _leaf(masked).alias("leaf"), _name(F.col("masked")).alias("line"),
        F.when(_n_tokens(masked) >= LONG_TOKENS, _name(F.col("single"))).alias("verbatim")), "lines")
    counted = stage(thin.groupBy("leaf", "line").agg(
        F.min("place").alias("a"), F.max("place").alias("b"), F.count("*").alias("n")), "counted")
    crowded = (counted.groupBy("leaf").agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))
        .where((F.col("a") < F.col("b")) & (F.col("n") >= min_documents)).select("leaf"))
    crowded = stage(crowded, "leaves")
    in_leaf = _join_counted(
        lines.withColumn("leaf", _leaf(masked)), crowded, "leaf", "left_semi")
    texts = in_leaf.groupBy("leaf", "masked").agg(
        F.count("*").alias("n")).withColumn("line", _name(F.col("masked")))
    # A row counts once, however many copies of a line it has.
    often = counted.where((F.col("a") < F.col("b")) & (F.col("n") >= min_documents)).select("line")
    own = (_join_counted(thin.select("line", "place"), often, "line", "left_semi").distinct()
           .groupBy("line").agg(F.count("*").alias("rows")).where(F.col("rows") >= min_documents)
           .select("line", F.lit(True).alias("recurs")))
    distinct = stage(_join_counted(texts, stage(own, "own"), "line", "left").withColumn(
        "recurs", F.coalesce("recurs", F.lit(False))), "distinct_lines")
    # A template of fields only says nothing. Asked of the written table, not of every line.
    distinct = distinct.where(F.exists(F.split("masked", " "), lambda t: t != FIELD))

    chosen = _belonging(distinct.where(_n_tokens(masked) > LEADING_TOKENS), thin, min_documents, similarity)
    members = stage(chosen.union(
        distinct.where("recurs").select("line", F.col("line").alias("template"))), "members")
    belongs = _join_counted(thin, members, "line").select("place", "line_no", "template")
    # Long lines word for word: two different rows are all that has to be known.
    long = thin.where("verbatim is not null")
    repeated = stage(long.groupBy("verbatim").agg(
        F.min("place").alias("a"), F.max("place").alias("b")).where("a < b").select("verbatim"), "repeated")
    again = _join_counted(
        _join_counted(long, repeated, "verbatim", "left_semi"), members, "line", "left_anti")
    belongs = stage(belongs.unionByName(again.select(
        "place", "line_no", F.col("verbatim").alias("template"))), "belongs")
    found = stage(belongs.select("template", "place").distinct().groupBy("template").agg(
        F.count("*").alias("n_documents"), F.min("place").alias("first_place")), "recurring")
    drop_staged(df.sparkSession, thin, counted, crowded, distinct, members)
    return found, belongs


def drop_recurring(
    df: DataFrame, column: str = "text", min_documents: int = MIN_DOCUMENTS,
    similarity: float = SIMILARITY, keep_first: bool = True, n_dropped: str = "n_dropped",
    n_chars: str | None = None,
) -> DataFrame:
    """df without the lines of recurring templates, and the number of lines dropped from each row.

    The first row that holds a template keeps its lines, so nothing that was said is lost; with
    ``keep_first=False`` every row loses them. Other lines stay as they are, in their order; a row
    may be left with an empty text, and null stays null. Lines without tokens are never dropped.
    ``n_chars`` names a column to set to the new length. df must read alike each time: rows are
    told apart by their place in it, so repeated rows and repeated ids are separate documents.
    """
    found, belongs = _recurring(df, column, min_documents, similarity)
    if keep_first:
        belongs = _join_counted(belongs, found.select("template", "first_place"), "template").where(
            "place <> first_place")
    place, lost = fresh(df, "place"), fresh(df, "lost")
    # As many numbers as the row has lines, whatever shares its templates.
    dropped = belongs.groupBy(F.col("place").alias(place)).agg(
        F.collect_set("line_no").alias(lost))
    placed = df.withColumn(place, F.monotonically_increasing_id())
    joined = _join_counted(placed, stage(dropped, "dropped"), place, "left")
    text, gone = F.col(quoted(column)), F.col(lost)
    shorter = F.array_join(F.filter(
        F.split(text, "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n")
    columns = {column: F.when(gone.isNull(), text).otherwise(shorter),
               n_dropped: F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long")}
    if n_chars is not None:
        columns[n_chars] = F.when(gone.isNull(), F.col(quoted(n_chars))).otherwise(
            F.length(shorter)).cast(df.schema[n_chars].dataType)
    order = [*[c for c in df.columns if c.lower() != n_dropped.lower()], n_dropped]
    return with_columns(joined, columns).select(*[F.col(quoted(c)) for c in order])
