"""Line dedup by a log-template tree (DataFrame operations only).

A line's words that hold a digit are variable from the start and become ``<*>``. The tree has a fixed depth. A line goes to the
leaf of its word count and its first three words. In a leaf the most frequent word of each position, over all documents,
makes the leaf's template; a line that agrees with it in four fifths of the positions belongs to it, so the other positions
are variable too. Lines that do not belong go one level down. Two lines that agree in four fifths of the positions are equal in
one of as many blocks of positions as they may differ in, and one more; each such line goes to the child of that block of its
own which the most documents share, and the child has a template in the same way. Lines that fit none recur by their exact words,
as do lines whose words are mostly variable. Positions that are variable in both are no agreement.

A template that lines of several documents have is recurring: its lines stay in the first document only.

Leaves, templates and documents are hashes until the end. A line's words are looked at again only in leaves that hold different
lines, and then each distinct line once, fetched from one of its documents. Everything per leaf or template is a count, a
maximum or an equi-join, and what is worked out for a line grows with its words, so a line that a third of all documents share is
summed up where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_ROWS, free_name, staged, table

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
#: A word with a digit; it is tried at the starts of words only.
VARIABLE = rf"(?<!{WORD})[^\x20\x09-\x0D0-9]*+[0-9]{WORD}*+"

DEPTH = 3
MIN_WORDS = 1
MIN_DOCS = 2
#: Positions of a hundred in which a line agrees with its template at least.
AGREE = 80


def _masked(lines: Column) -> Column:
    """Each line's words with one blank between them, variable ones as ``<*>``. Lines that have nothing to replace are
    only searched, which is much cheaper."""
    fixed = F.transform(lines, lambda x: F.when(x.rlike("[0-9]"), F.regexp_replace(x, VARIABLE, "<*>")).otherwise(x))
    single = F.transform(fixed, lambda x: F.when(x.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(x, rf"{SPACES}+", " ")).otherwise(x))
    return F.transform(single, lambda x: F.trim(x))  # F.trim itself would take the index as what to trim


def _exact(lines: Column) -> Column:
    """As ``_masked``, but a line whose words are mostly variable keeps them, after a line feed, which no line holds."""

    def one(masked: Column, line: Column) -> Column:
        words = F.split(masked, " ")
        mostly = masked.contains("<*>") & (2 * F.size(F.filter(words, lambda w: w == "<*>")) > F.size(words))
        return F.when(mostly, F.concat(F.lit("\n"), F.trim(F.regexp_replace(line, rf"{SPACES}+", " ")))).otherwise(masked)

    return F.zip_with(_masked(lines), lines, one)


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """id, hash, no, leaf and key of every line with enough words, blank lines left out."""
    # masked before the explode: what is exploded is not worked out anew for each column made of it
    lines = docs.select("id", "hash", F.posexplode(_exact(F.split("text", "\n"))).alias("no", "masked"))
    n = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    lines = lines.withColumn("n", n).where((F.col("n") >= min_words) & (F.col("masked") != ""))
    lead = F.when(F.col("masked").startswith("\n"), F.col("masked")).otherwise(F.substring_index("masked", " ", DEPTH))  # mostly variable ones: a leaf of their own
    return lines.select("id", "hash", "no", F.xxhash64("n", lead).alias("leaf"), F.xxhash64("masked").alias("key"))


def _fetched(docs: DataFrame, wanted: DataFrame, limit: int) -> DataFrame:
    """leaf, key, docs and words of the lines that ``wanted`` names by the hash of a text and a line number."""
    of_text = F.sort_array(F.collect_list(F.struct("no", "leaf", "key", "docs"))).alias("wanted")  # lines of one text
    by_text = staged(wanted.groupBy("hash").agg(of_text), "wanted")
    few = wanted.count() <= limit
    rows = docs.select("hash", "text").join(F.broadcast(by_text) if few else by_text, "hash")
    picked = F.filter(F.split("text", "\n"), lambda x, i: F.array_contains("wanted.no", i))
    lines = rows.select(F.explode(F.arrays_zip(_exact(picked).alias("masked"), F.col("wanted").alias("of"))).alias("line"))
    # copies give the same lines, and texts that only share a hash others
    right = lines.where(F.xxhash64("line.masked") == F.col("line.of.key"))
    return right.select("line.of.leaf", "line.of.key", "line.of.docs", F.split("line.masked", " ").alias("words")).dropDuplicates(["leaf", "key"])


def _agreeing(lines: DataFrame, group: str, name: str) -> DataFrame:
    """The rows of ``lines`` (words, docs) that agree with the most frequent words of their group's positions."""
    constants = (
        lines.select(group, "docs", F.posexplode("words").alias("pos", "word"))
        .groupBy(group, "pos", "word")
        .agg(F.sum("docs").alias("docs"))
        .groupBy(group, "pos")
        .agg(F.max(F.struct("docs", "word")).alias("most"))
        .groupBy(group)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "most.word"))).alias("most"))  # as long as a line
    )
    pairs = F.zip_with("words", "most.word", lambda w, c: F.when(w != c, 0).when(w == "<*>", 1).otherwise(2))
    found = lines.join(staged(constants, name), group).withColumn("pairs", pairs)
    counted, same = F.size(F.filter("pairs", lambda p: p != 1)), F.size(F.filter("pairs", lambda p: p == 2))
    return found.where(100 * same >= AGREE * counted).drop("pairs", "most")


def _child_templates(left: DataFrame) -> DataFrame:
    """(leaf, key, template) of the lines that fit the child of their most shared block; ``left`` has those without a template."""
    spare = F.floor(F.size("words") * (100 - AGREE) / 100).cast("int")
    left = staged(left.where(F.size("words") > DEPTH).withColumn("spare", spare), "left")
    start = f"{DEPTH} + j * (size(words) - {DEPTH}) div (spare + 1)"
    end = f"{DEPTH} + (j + 1) * (size(words) - {DEPTH}) div (spare + 1)"
    blocks = F.expr(f"transform(sequence(0, spare), j -> xxhash64(leaf, j, array_join(slice(words, cast({start} + 1 as int), cast(({end}) - ({start}) as int)), ' ')))")
    spread = staged(left.select("leaf", "key", "docs", F.posexplode(blocks).alias("j", "child")), "children")
    shared = spread.groupBy("child").agg(F.sum("docs").alias("weight"), F.count(F.lit(1)).alias("n")).where("n > 1").select("child", "weight")
    own = F.max(F.struct("weight", (-F.col("j")).alias("j"), "child")).alias("own")
    chosen = spread.join(shared, "child").groupBy("leaf", "key").agg(own).select("leaf", "key", F.col("own.child").alias("template"))
    fits = staged(_agreeing(staged(left.join(chosen, ["leaf", "key"]), "chosen"), "template", "child_words").select("leaf", "key", "template"), "child_fits")
    several = fits.groupBy("template").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("template")
    return fits.join(several, "template", "left_semi").select("leaf", "key", "template")


def _template_lines(docs: DataFrame, weights: DataFrame, limit: int) -> DataFrame:
    """(leaf, key, template) of the lines that belong to a template of their leaf, in leaves with different lines."""
    varied = weights.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("leaf")
    wanted = staged(weights.join(varied, "leaf", "left_semi").select("leaf", "key", "docs", "place.hash", "place.no"), "varied")
    lines = staged(_fetched(docs, wanted, limit), "texts")
    first = staged(_agreeing(lines, "leaf", "leaf_words").select("leaf", "key", F.lit(0).cast("long").alias("template")), "first")
    return first.union(_child_templates(lines.join(first, ["leaf", "key"], "left_anti")))


def drop_recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    min_docs: int = MIN_DOCS,
    lines_out: str = "n_lines",
    dropped_out: str = "n_dropped",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All rows and columns of ``docs`` with recurring lines cut from the text, plus the counts of lines and of dropped ones.

    Lines end at line feeds. A line of fewer than ``min_words`` words never goes, nor does a blank one. A template recurs
    when ``min_docs`` documents have it; the document with the smallest id keeps its lines (null ids are smallest, of
    equal ids the smaller hash of the text). Rows with one id and text are one document and lose the same lines. Null
    texts stay null with no lines; an empty text is one line. A column that already has an output's name keeps it, and
    the output's gets underscores in front. An empty table gives no rows.
    """
    names = {c: free_name(docs, c) for c in ("__id", "__hash", "__drop", lines_out, dropped_out)}
    rows = docs.withColumns({names["__id"]: F.col(id_col), names["__hash"]: F.xxhash64(text_col)})
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    light = staged(_lines(source, min_words), "lines")
    doc = F.xxhash64("id", "hash")
    shared = light.groupBy("leaf").agg(F.min(doc).alias("low"), F.max(doc).alias("high")).where("low <> high").select("leaf") if min_docs > 1 else light.select("leaf").distinct()
    candidates = staged(light.join(shared, "leaf", "left_semi"), "candidates")
    in_docs = candidates.groupBy("leaf", "key", "id", "hash").agg(F.min("no").alias("no"))
    weights = staged(in_docs.groupBy("leaf", "key").agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("hash", "no")).alias("place")), "weights")
    fitting = _template_lines(source, weights, broadcast_rows)
    placed = candidates.join(fitting, ["leaf", "key"], "left").select("id", "hash", "no", "leaf", F.coalesce("template", "key").alias("template"), F.col("template").isNotNull().alias("fits"))
    placed = staged(placed, "placed")
    same = ["leaf", "template", "fits"]
    recurring = placed.select(*same, "id", "hash").distinct().groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash")).alias("first")).where(F.col("n") >= min_docs)
    dropped = placed.join(recurring.select(*same, "first"), same).where(~F.struct("id", "hash").eqNullSafe(F.col("first")))
    by_doc = dropped.groupBy("id", "hash").agg(F.sort_array(F.collect_set("no")).alias("drop"))  # lines of one document

    found = by_doc.select(F.col("id").alias("drop_id"), F.col("hash").alias("drop_hash"), F.col("drop").alias(names["__drop"]))
    out = rows.join(found, F.col(names["__id"]).eqNullSafe(F.col("drop_id")) & (F.col(names["__hash"]) == F.col("drop_hash")), "left").drop("drop_id", "drop_hash")
    text, drop = f"`{text_col}`", f"`{names['__drop']}`"
    # the stretches between dropped lines, one after the other; the text is cut once
    kept = f"""transform(array(split({text}, '\\n')), c -> array_join(flatten(transform(sequence(0, size({drop})), i -> slice(c,
        if(i = 0, 1, {drop}[i - 1] + 2),
        if(i = size({drop}), size(c), {drop}[i]) - if(i = 0, 0, {drop}[i - 1] + 1)))), '\\n'))[0]"""
    out = out.withColumns({
        names[lines_out]: F.expr(f"if({text} is null, 0, size(split({text}, '\\n')))"),
        names[dropped_out]: F.expr(f"if({drop} is null, 0, size({drop}))"),
        text_col: F.expr(f"if({drop} is null, {text}, {kept})"),
    })
    return out.drop(names["__id"], names["__hash"], names["__drop"])


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP5_SQL = r"""
WITH cut AS (
  SELECT doc_id, generate_subscripts(l, 1) - 1 AS no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
plain AS (SELECT doc_id, no, [w FOR w IN string_split_regex(line, '[\x20\x09-\x0D]+') IF w <> ''] AS own FROM cut),
masked AS (SELECT doc_id, no, own, [CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END FOR w IN own] AS m FROM plain WHERE len(own) > 0),
filed AS (
  SELECT doc_id, no, len(own) AS n, CASE WHEN 2 * len([w FOR w IN m IF w = '<*>']) > len(m) THEN chr(10) || array_to_string(own, ' ') END AS mostly, m AS words,
    coalesce(mostly, array_to_string(m, ' ')) AS key, coalesce(mostly, array_to_string(m[1:3], ' ')) AS lead FROM masked),
weights AS (SELECT n, lead, key, any_value(words) AS words, any_value(mostly) AS mostly, count(DISTINCT doc_id) AS docs FROM filed GROUP BY n, lead, key),
positions AS (SELECT n, lead, key, docs, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM weights WHERE mostly IS NULL),
modes AS (
  SELECT n, lead, pos, word AS constant FROM (SELECT n, lead, pos, word, sum(docs) AS docs FROM positions GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY n, lead, pos ORDER BY docs DESC, word DESC) = 1),
agreed AS (
  SELECT n, lead, key, 100 * count(*) FILTER (word = constant AND word <> '<*>') >= 80 * count(*) FILTER (word <> constant OR word <> '<*>') AS fits
  FROM positions JOIN modes USING (n, lead, pos) GROUP BY n, lead, key),
remaining AS (SELECT w.n, w.lead, w.key, docs, words, w.n * 20 // 100 AS spare FROM weights w JOIN agreed USING (n, lead, key) WHERE NOT fits AND w.n > 3),
blocks AS (
  SELECT n, lead, key, docs, words, j, array_to_string(words[3 + j * (n - 3) // (spare + 1) + 1 : 3 + (j + 1) * (n - 3) // (spare + 1)], ' ') AS block
  FROM (SELECT *, unnest(range(spare + 1)) AS j FROM remaining)),
children AS (SELECT n, lead, j, block, sum(docs) AS weight FROM blocks GROUP BY n, lead, j, block HAVING count(*) > 1),
chosen AS (
  SELECT n, lead, key, docs, words, j, block FROM blocks JOIN children USING (n, lead, j, block)
  QUALIFY row_number() OVER (PARTITION BY n, lead, key ORDER BY weight DESC, j) = 1),
child_positions AS (SELECT n, lead, key, docs, j, block, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM chosen),
child_modes AS (
  SELECT n, lead, j, block, pos, word AS constant FROM (SELECT n, lead, j, block, pos, word, sum(docs) AS docs FROM child_positions GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY n, lead, j, block, pos ORDER BY docs DESC, word DESC) = 1),
child_fits AS (
  SELECT n, lead, key, j, block FROM child_positions JOIN child_modes USING (n, lead, j, block, pos) GROUP BY n, lead, key, j, block
  HAVING 100 * count(*) FILTER (word = constant AND word <> '<*>') >= 80 * count(*) FILTER (word <> constant OR word <> '<*>')
  QUALIFY count(*) OVER (PARTITION BY n, lead, j, block) > 1),
placed AS (
  SELECT doc_id, no, f.n, f.lead, CASE WHEN coalesce(a.fits, false) THEN 'leaf' WHEN c.j IS NOT NULL THEN 'child ' || c.j ELSE 'line' END AS kind,
    CASE WHEN coalesce(a.fits, false) THEN '' WHEN c.j IS NOT NULL THEN c.block ELSE f.key END AS template
  FROM filed f LEFT JOIN agreed a USING (n, lead, key) LEFT JOIN child_fits c USING (n, lead, key)),
dropped AS (
  SELECT DISTINCT doc_id, no FROM placed JOIN (
    SELECT n, lead, kind, template, min(doc_id) AS first FROM placed GROUP BY ALL HAVING count(DISTINCT doc_id) >= 2) USING (n, lead, kind, template)
  WHERE doc_id <> first),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(d.no) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY cut.no) FILTER (d.no IS NULL), '') AS text
  FROM cut LEFT JOIN dropped d USING (doc_id, no) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::INTEGER AS n_lines, coalesce(n_dropped, 0)::INTEGER AS n_dropped, sha256(coalesce(kept.text, '')) AS text_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
