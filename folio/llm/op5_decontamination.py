r"""Benchmark decontamination by template canonicalisation.

Texts become canonical tokens. A number with its separators (3.5, 1,200), a number word, a name or a unit is a value, any
other run of letters, marks and digits a literal, lower-cased; a run of numbers or of names (Mary Ann) is one value. In the
template a value is the placeholder of its type. A name is one of NAMES, or a capitalised word after a lower-case letter,
comma or semicolon and a space, but not after one of NOUN_AFTER as the token before: German writes its nouns with capitals.

A benchmark item's windows are its runs of `width` tokens; an item of 10 tokens to twice the width has windows of half its
tokens, a shorter one of `width` or all. A window with at least `literals` literals (or of literals only) is searched by its
template, a weaker one by its exact tokens, so all windows are searched. Matched windows of an item are taken together over neighbouring diagonals of a
document, each at most a quarter of the item's tokens from the next, and on each diagonal alone. They are consistent if no
benchmark value stands for two document values; one document value may stand for several. A document is contaminated by an
item if consistent windows cover at least `share` hundredths of the item's tokens, counted on both sides, the smaller count
holding. So changed values of any length and single added, missing or changed words are found.

Each window has an anchor, its longest literal (longest value where it has none). The documents' tokens are probed for the
anchors, and only around those found are windows cut and joined on the hash of their template. Up to BROADCAST_ROWS, the
benchmark's tables are broadcast and the context rides along in the exploded row, so that no text is shuffled; beyond,
places of anchors are joined by a shuffle and go back to their document by doc_id. All of it is DataFrame operations.

Cases: null and empty texts and items match nothing; rows with the same doc_id are one document, repeated item rows one
item, and texts of one item_id its variants; rows with null doc_id or item_id are left out; control characters used as
marks count as spaces; a very long text costs its own tokens; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored

#: Common given names, units, number words, and German words before nouns.
NAMES = "alice bob carol dave eve frank grace henry ivan james john mary maria anna emma liam noah olivia sophia mia lucas paul peter tom sam sara sarah david daniel michael linda susan karen jane jack kate laura mark emily".split()
UNITS = "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ml l liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres percent dollar dollars euro euros cent cents degree degrees mph kph".split()
NUMBERS = "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()
NOUN_AFTER = "der die das den dem des ein eine einen einem einer eines kein keine keinen keinem keiner mein meine meinen meinem meiner sein seine seinen seinem seiner ihr ihre ihren ihrem ihrer und oder mit von zu zum zur im am auf bei nach aus vor".split()
#: Marks at the end of a number, a name and a unit; NAME also stands before a name until it is lower-cased.
NUM, NAME, UNIT, POINT = "\x03", "\x04", "\x05", "\x02"
#: Most rows of a benchmark table that is broadcast.
BROADCAST_ROWS = 200_000


def canonical(rows: DataFrame, *kept: str) -> DataFrame:
    """Rows (kept, v): the canonical tokens of text; a value ends in the mark of its type."""
    c = F.coalesce("text", F.lit(""))
    c = F.when(c.rlike(f"[{POINT}{NUM}{NAME}{UNIT}]"), F.translate(c, POINT + NUM + NAME + UNIT, "    ")).otherwise(c)
    c = F.lower(F.regexp_replace(c, r"(?<=[\p{Ll},;] )(?=\p{Lu}\p{Ll})", NAME))
    c = F.regexp_replace(c, r"(?<=\p{N})[.,](?=\p{N})", POINT)
    flat = F.split(F.trim(F.regexp_replace(c, rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}{POINT}]+", " ")), " ")

    def marked(t, i):
        word = F.when(t.startswith(NAME), F.substring(t, F.lit(2), F.length(t))).otherwise(t)
        named = t.startswith(NAME) & ~F.coalesce(F.get("flat_", i - 1).isin(NOUN_AFTER), F.lit(False))
        number = word.rlike(r"^\p{N}") | word.isin(NUMBERS)
        kind = F.when(named | (~number & word.isin(NAMES)), NAME).when(number, NUM).when(word.isin(UNITS), UNIT).otherwise("")
        # Most tokens are neither marked nor numbers nor in a list, which two comparisons and a look-up show.
        return F.when((t >= "a") & (t < "{") & ~t.isin(NAMES + UNITS + NUMBERS), t).otherwise(F.concat(word, kind))

    rows = rows.select(*kept, flat.alias("flat_"))
    rows = rows.select(*kept, F.array_join(F.transform("flat_", marked), " ").alias("joined_"))
    runs = F.regexp_replace("joined_", rf"(?<={NUM}) (?=[^ ]*{NUM})|(?<={NAME}) (?=[^ ]*{NAME})", "_")
    return rows.select(*kept, F.split(runs, " ").alias("v"))


def template(form):
    """Tokens parted by spaces with each value as the mark of its type."""
    return F.regexp_replace(form, rf"(?<![^ ])[^ ]*([{NUM}{NAME}{UNIT}])(?![^ ])", "$1")


def is_value(t):
    return t.rlike(f"[{NUM}{NAME}{UNIT}]$")


def windows(benchmark: DataFrame, width: int, literals: int) -> DataFrame:
    """Rows (item_id, variant, at, n, slack, w, strong, raw, form, anchor, off) of each item's windows."""
    items = canonical(benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id").where(F.array_join("v", "") != "").dropDuplicates()
    n = F.size("v")
    items = items.withColumn("w", F.when(n.between(10, 2 * width), F.least(F.lit(width), F.floor(n / 2).cast("int"))).otherwise(F.least(F.lit(width), n)))
    at = items.select("item_id", F.xxhash64("v").alias("variant"), "v", "w", F.explode(F.sequence(F.lit(0), n - F.col("w"))).alias("at"))
    cut = at.select("item_id", "variant", "at", n.alias("n"), "w", F.slice("v", F.col("at") + 1, F.col("w")).alias("raw"))
    cut = cut.withColumn("strong", F.size(F.filter("raw", lambda t: ~is_value(t))) >= F.least(F.lit(literals), F.col("w")))
    top = F.array_max(F.transform("raw", lambda t, i: F.struct((~is_value(t)).alias("literal"), F.length(t).alias("n"), t.alias("t"), (-i).alias("back"))))
    form = F.when(F.col("strong"), template(F.array_join("raw", " "))).otherwise(F.array_join("raw", " "))
    return cut.select("item_id", "variant", "at", "n", F.greatest(F.lit(1), F.floor(F.col("n") / 4).cast("int")).alias("slack"), "w", "strong", "raw", form.alias("form"), top["t"].alias("anchor"), (-top["back"]).alias("off"))


def matches(docs: DataFrame, benchmark: DataFrame, width: int = 8, literals: int = 3) -> DataFrame:
    """Rows (doc_id, item_id, variant, start, at, w, n, slack, slots): each matched window, with its values as (item's, document's)."""
    docs = canonical(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    searched = stored(windows(benchmark, width, literals), "windows")
    places = searched.groupBy(F.col("anchor").alias("token")).agg(F.collect_set(F.struct("off", "w", "strong")).alias("cuts"))
    small = searched.count() <= BROADCAST_ROWS
    if small:
        # The outer form, since for the other one Spark infers a filter on the tokens and works them out twice.
        hits = docs.select("doc_id", "v", F.posexplode_outer("v").alias("pos", "token")).join(F.broadcast(places), "token")
    else:
        found = docs.select("doc_id", F.posexplode_outer("v").alias("pos", "token")).join(places, "token").groupBy("doc_id").agg(F.collect_list(F.struct("pos", "cuts")).alias("found"))
        hits = docs.join(found, "doc_id").select("doc_id", "v", F.explode("found").alias("f")).select("doc_id", "v", "f.pos", "f.cuts")
    cut = hits.select("doc_id", "v", "pos", F.explode("cuts").alias("c")).withColumn("start", F.col("pos") - F.col("c.off")).where("start >= 0 and start + c.w <= size(v)")
    cut = cut.select("doc_id", "start", "c.w", "c.strong", F.slice("v", F.col("start") + 1, F.col("c.w")).alias("own"))
    exact = F.array_join("own", " ")
    cut = cut.select("doc_id", "start", "w", "strong", "own", F.when(F.col("strong"), template(exact)).otherwise(exact).alias("form"))
    key = F.xxhash64("w", "strong", "form").alias("h")
    side = searched.select(key, F.col("form").alias("form_"), "item_id", "variant", "at", "n", "slack", "raw")
    found = cut.withColumn("h", key).join(F.broadcast(side) if small else side, "h").where("form = form_")
    slots = F.filter(F.zip_with("raw", "own", lambda b, d: F.when(is_value(b), F.struct(b.alias("b"), d.alias("d")))), lambda x: x.isNotNull())
    return found.select("doc_id", "item_id", "variant", "start", "at", "w", "n", "slack", slots.alias("slots")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 8, literals: int = 3, share: int = 50) -> DataFrame:
    """Rows (doc_id, item_id, n_covered, n_tokens, n_slots, verbatim) of contaminated pairs: the best place of each."""
    pair = ["doc_id", "item_id", "variant", "n", "slack"]
    by = matches(docs, benchmark, width, literals).groupBy(*pair, (F.col("start") - F.col("at")).alias("diagonal"))
    of = by.agg(F.collect_list(F.struct("at", "start", "w")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"))
    line = Window.partitionBy(*pair).orderBy("diagonal")
    far = (F.col("diagonal") - F.lag("diagonal").over(line) > F.col("slack")).cast("int")
    of = of.withColumn("far", far).withColumn("island", F.coalesce(F.sum("far").over(line), F.lit(0)))
    of = of.groupBy(*pair, "island").agg(F.collect_list(F.struct("spans", "slots")).alias("parts"))
    whole = F.struct(F.flatten(F.transform("parts", lambda p: p["spans"])).alias("spans"), F.array_distinct(F.flatten(F.transform("parts", lambda p: p["slots"]))).alias("slots"))
    of = of.select(*pair, F.explode(F.concat(F.array(whole), F.col("parts"))).alias("p")).select(*pair, "p.*")
    covered = lambda side: F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s[side], s[side] + s["w"] - 1)))))
    of = of.withColumn("n_covered", F.least(covered("at"), covered("start")).cast("long")).withColumn("n_slots", F.size("slots").cast("long"))
    consistent = F.size(F.array_distinct(F.transform("slots", lambda s: s["b"]))) == F.size("slots")
    of = of.where(consistent & (100 * F.col("n_covered") >= share * F.col("n")))
    of = of.withColumn("verbatim", F.forall("slots", lambda s: s["b"] == s["d"]))
    best = F.max(F.struct("n_covered", "verbatim", "n_slots", F.col("n").cast("long").alias("n_tokens"))).alias("x")
    return of.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "x.n_covered", "x.n_tokens", "x.n_slots", "x.verbatim")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


_NAMED = "regexp_replace(%s, '([\\p{Ll},;]) (\\p{Lu}\\p{Ll})', '\\1 ' || chr(4) || '\\2', 'g')"
_JOINED = "regexp_replace(%s, '(\\p{N})[.,](\\p{N})', '\\1' || chr(2) || '\\2', 'g')"


def _twice(form, inner):
    return form.replace("%s", form.replace("%s", inner))


_FLAT = _twice(_JOINED, "lower(" + _twice(_NAMED, "translate(coalesce(text, ''), chr(2) || chr(3) || chr(4) || chr(5), '    ')") + ")")
ORACLE = rf"""
WITH x AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents WHERE doc_id IS NOT NULL UNION ALL SELECT 'b', item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)
), r AS (
  SELECT row_number() OVER () AS rid, side, id, string_split(trim(regexp_replace({_FLAT}, '[^\p{{L}}\p{{M}}\p{{N}}\x02\x04]+', ' ', 'g')), ' ') AS t FROM x
), e AS (
  SELECT rid, side, id, pos, CASE WHEN pos > 1 AND t[pos - 1] IN ({_in(NOUN_AFTER)}) THEN replace(t[pos], chr(4), '') ELSE t[pos] END AS x FROM (SELECT *, unnest(range(1, len(t) + 1)) AS pos FROM r)
), f AS (
  SELECT rid, side, id, pos, replace(x, chr(4), '') AS x, CASE WHEN starts_with(x, chr(4)) THEN 'name' WHEN regexp_matches(x, '^\p{{N}}') OR x IN ({_in(NUMBERS)}) THEN 'num' WHEN x IN ({_in(NAMES)}) THEN 'name' WHEN x IN ({_in(UNITS)}) THEN 'unit' END AS kind FROM e
), g AS (
  SELECT *, CASE WHEN kind IN ('num', 'name') AND kind = lag(kind) OVER (PARTITION BY rid ORDER BY pos) THEN 0 ELSE 1 END AS first FROM f
), h AS (
  SELECT *, sum(first) OVER (PARTITION BY rid ORDER BY pos) AS place FROM g
), c AS (
  SELECT rid, side, id, place, string_agg(x, '_' ORDER BY pos) || coalesce('<' || any_value(kind), '') AS v, coalesce('<' || any_value(kind), any_value(x)) AS k FROM h GROUP BY rid, side, id, place
), a AS (
  SELECT rid, side, id, list(v ORDER BY place) AS v, list(k ORDER BY place) AS k FROM c GROUP BY ALL
), i AS (
  SELECT DISTINCT id AS item_id, v, k, len(v) AS n, CASE WHEN len(v) BETWEEN 10 AND 16 THEN least(8, len(v) // 2) ELSE least(8, len(v)) END AS w, greatest(1, len(v) // 4) AS slack FROM a WHERE side = 'b' AND v <> ['']
), b AS (
  SELECT *, CASE WHEN len(list_filter(raw, lambda x: NOT contains(x, '<'))) >= least(3, w) THEN 's ' || array_to_string(typed, ' ') ELSE 'w ' || array_to_string(raw, ' ') END AS form FROM (
    SELECT item_id, v AS variant, n, w, slack, place, v[place + 1 : place + w] AS raw, k[place + 1 : place + w] AS typed FROM (SELECT *, unnest(range(0, n - w + 1)) AS place FROM i))
), d AS (
  SELECT id AS doc_id, w, start, v[start + 1 : start + w] AS own, k[start + 1 : start + w] AS typed FROM (
    SELECT *, unnest(range(0, len(v) - w + 1)) AS start FROM a, (SELECT DISTINCT w FROM b) WHERE side = 'd' AND len(v) >= w)
), m AS (
  SELECT doc_id, item_id, variant, n, slack, b.w, start, place, start - place AS diagonal, raw, own FROM (
    SELECT *, CASE WHEN len(list_filter(own, lambda x: NOT contains(x, '<'))) >= least(3, w) THEN 's ' || array_to_string(typed, ' ') ELSE 'w ' || array_to_string(own, ' ') END AS form FROM d) d JOIN b USING (w, form)
), l AS (
  SELECT *, sum(CASE WHEN diagonal - before > slack THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, item_id, variant ORDER BY diagonal) AS island FROM (
    SELECT *, lag(diagonal) OVER (PARTITION BY doc_id, item_id, variant ORDER BY diagonal) AS before FROM (SELECT DISTINCT doc_id, item_id, variant, slack, diagonal FROM m))
), u AS (
  SELECT m.*, 'd' || m.diagonal AS unit FROM m UNION ALL SELECT m.*, 'i' || island FROM m JOIN l USING (doc_id, item_id, variant, diagonal)
), o AS (
  SELECT doc_id, item_id, variant, n, unit, least(count(DISTINCT p), count(DISTINCT q)) AS n_covered FROM (
    SELECT doc_id, item_id, variant, n, unit, unnest(range(place, place + w)) AS p, unnest(range(start, start + w)) AS q FROM u) GROUP BY ALL
), s AS (
  SELECT doc_id, item_id, variant, unit, count(DISTINCT z) AS n_slots, count(DISTINCT z[1]) AS n_values, bool_and(z[1] = z[2]) AS same FROM (
    SELECT doc_id, item_id, variant, unit, unnest(list_zip(raw, own)) AS z FROM u) WHERE contains(z[1], '<') GROUP BY ALL
)
SELECT doc_id, item_id, n_covered, CAST(n AS BIGINT) AS n_tokens, n_slots, verbatim FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_covered DESC, verbatim DESC, n_slots DESC, n DESC) AS first FROM (
    SELECT o.doc_id, o.item_id, n_covered, n, coalesce(n_slots, 0) AS n_slots, coalesce(same, true) AS verbatim
    FROM o LEFT JOIN s ON o.doc_id = s.doc_id AND o.item_id = s.item_id AND o.variant = s.variant AND o.unit = s.unit
    WHERE coalesce(n_values = n_slots, true) AND 100 * n_covered >= 50 * n)) WHERE first = 1
"""
