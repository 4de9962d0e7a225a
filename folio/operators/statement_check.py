"""The total check of whole statements: every total against the rules of its statement's type, as one plan over all statements.

Lines: doc_id, stmt_type, table_id, section, row_order, flag, label, datapoint, cols, col_pos, amts; flag DP for items, CP for totals, DPG
for headings; row_order is the place in the document; cols, col_pos and amts are arrays with an element for each value column. Tidy rows
have one row for each value column instead: col, col_pos, amt. A document's lines are gathered into one array, which is as long as a
statement is; what a rule asks of a line is asked once, not for each column. Rules are joined to totals by name, and each rule reads its
values from the lines. Names, sections and labels are compared without case. A missing amount is 0. Sections whose names differ in case
only are one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.rule_sets import RULES, SELF_CHECKED

MONEY = "decimal(38,4)"
TABLE = ["doc_id", "table_id"]
TOTAL = [*TABLE, "row_order", "section", "datapoint"]
#: A gathered line, in the order in which lines are sorted.
LINE = ["row_order", "sec", "item", "name", "lab", "amts", "pos", "section", "datapoint", "table_id", "cols"]
SOURCE = "struct<kind:string,name:string,section:string>"
RULE = f"seq int, name string, kind string, section string, contains array<string>, excludes array<string>, chains array<struct<members:array<struct<sign:int,required:boolean,sources:array<{SOURCE}>>>>>, pick string, only string"


def rules_table(spark: SparkSession) -> DataFrame:
    """Rows (rule_of, rule_name, rules): the rules of each type's totals by name, in the order in which they are applied as seq; `*` for
    the names without rules of their own. Some hundred rows."""
    low = lambda x: None if x is None else x.strip().lower()
    chain = lambda c: [([(m.sign, m.required, [(s.kind, low(s.name), low(s.section)) for s in m.sources]) for m in c],)]
    rows = []
    for kind, rules in RULES.items():
        of = [(seq, low(r.name), r.kind, low(r.section), list(r.contains), list(r.excludes), [x for c in r.chains for x in chain(c)], r.pick, r.when) for seq, r in enumerate(rules)]
        rows += [(kind, name, [r for r in of if r[1] in (name, "*")]) for name in {"*", *(r[1] for r in of)}]
    return spark.createDataFrame(rows, f"rule_of string, rule_name string, rules array<struct<{', '.join(f.replace(' ', ':', 1) for f in RULE.split(', '))}>>")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), the value being worked out once; what a lambda names is else worked out for each of its elements."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _sum(lines: Column, places: Column) -> Column:
    """The sums of the lines' amounts, one for each of the columns' places."""
    return _let(lines, lambda own: F.transform(places, lambda j: F.aggregate(own, F.lit(0).cast(MONEY), lambda a, x: (a + F.get(x["amts"], j)).cast(MONEY))))


def _candidate(values: Column, usable: Column = None) -> Column:
    return F.struct((F.lit(True) if usable is None else F.coalesce(usable, F.lit(False))).alias("usable"), values.alias("values"))


def _source(lines: Column, places: Column, s: Column) -> Column:
    """The values of one source in all columns; null if it isn't there."""
    exact = F.filter(lines, lambda x: ~x["item"] & (x["name"] == s["name"]))
    near = F.filter(lines, lambda x: ~x["item"] & s["name"].contains(x["name"]) & (F.length(x["name"]) < F.length(s["name"])))
    inside = lambda x: s["section"].isNull() | (x["sec"] == s["section"])
    named = F.filter(lines, lambda x: x["item"] & (x["name"] == s["name"]) & inside(x))
    section = F.filter(lines, lambda x: x["item"] & (x["sec"] == s["section"]))
    last = F.try_element_at(exact, F.lit(-1))["amts"]
    added = lambda some: _let(some, lambda x: F.when(F.size(x) > 0, _sum(x, places)))
    # Of items alike in all but their amounts the least amount of each column comes first.
    alike = lambda some, x: x["row_order"].eqNullSafe(some[0]["row_order"]) & x["sec"].eqNullSafe(some[0]["sec"]) & (x["lab"] == some[0]["lab"])
    lowest = lambda some, j: F.array_min(F.transform(F.filter(some, lambda x: alike(some, x)), lambda x: F.get(x["amts"], j)))
    least = lambda some: F.when(F.size(some) > 0, F.transform(places, lambda j: lowest(some, j)))
    kind = s["kind"]
    return F.when(kind == "total", F.coalesce(last, F.get(near, F.lit(0))["amts"])).when(kind == "exact", last).when(kind == "item", _let(named, least)).when(kind == "items", added(named)).when(kind == "section", added(section))


def _formula(lines: Column, places: Column, chain: Column) -> Column:
    value = lambda m: F.get(F.filter(F.transform(m["sources"], lambda s: _source(lines, places, s)), lambda v: v.isNotNull()), F.lit(0))
    zero = F.lit(0).cast(MONEY)
    member = lambda m: _let(value(m), lambda v: F.struct(m["sign"].alias("sign"), v.alias("values"), (~m["required"] | v.isNotNull()).alias("ok")))
    added = lambda of, j: F.aggregate(of, zero, lambda a, m: (a + (m["sign"] * F.coalesce(F.get(m["values"], j), zero)).cast(MONEY)).cast(MONEY))
    return _let(F.transform(chain["members"], member), lambda of: _candidate(F.transform(places, lambda j: added(of, j)), F.forall(of, lambda m: m["ok"])))


#: Kinds of sums that have a second one, which is tried after the first.
TWICE = ["labels_positional", "rolling", "current_liabilities"]


def _tries(rule: Column) -> Column:
    """How many sums or formulas a rule has."""
    twice = rule["kind"].isin(TWICE) | ((rule["kind"] == "section") & (F.size(rule["excludes"]) > 0))
    return F.when(rule["kind"] == "chains", F.size(rule["chains"])).when(twice, 2).otherwise(1)


def _sums(r: dict[str, Column], i: Column) -> Column:
    """The i-th candidate of a rule of sums, in the order in which they are tried."""
    hit = lambda x: (F.size(r["contains"]) == 0) | F.exists(r["contains"], lambda c: x["lab"].contains(c))
    out = lambda x: F.exists(r["excludes"], lambda e: x["lab"].contains(e))
    starts = lambda x: F.exists(r["excludes"], lambda e: x["lab"].startswith(e))
    kept = lambda a: F.filter(a, lambda x: hit(x) & ~out(x))
    earlier = lambda pool: F.filter(pool, lambda x: ~x["item"] & (x["row_order"] < r["row_order"]))
    total = lambda lines: _sum(lines, r["places"])
    kind = r["kind"]

    def since_total(pool: Column, items: Column) -> Column:
        def tried(last: Column) -> Column:
            window = F.filter(items, lambda x: (x["row_order"] < r["row_order"]) & (x["row_order"] > F.coalesce(last["row_order"], F.lit(-1))))
            with_last = lambda lines: F.when(last.isNotNull(), F.zip_with(total(lines), last["amts"], lambda a, b: (a + b).cast(MONEY)))

            def of(window: Column, chosen: Column) -> Column:
                return (
                    F.when(kind == "labels_since_total", _candidate(total(chosen)))
                    .when(kind == "labels_positional", F.when(i == 0, _candidate(total(chosen), (F.size(chosen) > 0) | (F.size(window) == 0))).otherwise(_candidate(total(window))))
                    .otherwise(F.when(i == 0, _candidate(total(chosen))).otherwise(_candidate(with_last(chosen), last.isNotNull())))
                )

            return _let(window, lambda w: _let(kept(w), lambda chosen: of(w, chosen)))

        return _let(F.try_element_at(earlier(pool), F.lit(-1)), tried)

    def current(pool: Column, items: Column) -> Column:
        prefixed = F.filter(items, lambda x: F.trim(x["lab"]).startswith("current liabilities:"))
        own = _let(prefixed, lambda p: F.when(F.size(p) > 0, p).otherwise(F.filter(items, lambda x: ~x["name"].endswith("- noncurrent"))))
        blank = _let(F.filter(earlier(pool), lambda x: x["name"] == ""), lambda b: _candidate(total(b), F.size(b) > 0))
        return F.when(i == 0, _candidate(total(own))).otherwise(blank)

    def schedule() -> Column:
        # A debt schedule's premium or discount isn't summed; it counts towards the total debt service.
        own = total(F.filter(r["lines"], lambda x: x["item"] & (x["sec"] == r["sec"])))
        column = lambda j: F.lower(F.trim(F.get(r["cols"], j)))
        with_premium = lambda v: (v + F.coalesce(r["premium"], F.lit(0))).cast(MONEY)
        return _let(own, lambda own: F.transform(r["places"], lambda j: F.when(column(j) == "premium/discount", F.get(r["reported"], j)).when(column(j) == "total debt service", with_premium(F.get(own, j))).otherwise(F.get(own, j))))

    def tried(pool: Column, items: Column) -> Column:
        chosen = (
            F.when((kind == "section") & (i == 0), F.filter(items, lambda x: ~out(x)))
            .when(kind.isin("section", "blank"), items)
            .when(kind == "labels", kept(items))
            .when(kind == "labels_not_start", F.filter(items, lambda x: hit(x) & ~starts(x)))
            .when(kind == "names", F.filter(items, lambda x: F.exists(r["contains"], lambda c: c == x["name"]) & ~out(x)))
        )
        return F.when(kind.isin("labels_since_total", "labels_positional", "rolling"), since_total(pool, items)).when(kind == "current_liabilities", current(pool, items)).when(kind == "schedule", _candidate(schedule())).otherwise(_candidate(total(chosen)))

    pool = F.when(r["section"].isNull(), r["lines"]).otherwise(F.filter(r["lines"], lambda x: x["sec"] == r["section"]))
    return _let(pool, lambda p: _let(F.filter(p, lambda x: x["item"]), lambda items: tried(p, items)))


def _blocks(of: DataFrame) -> DataFrame:
    """of (lines, headings, kind) with blocks (cols, lines) in place of its lines, and between. One block of all columns if all lines have the
    same ones and each total a place of its own; else one for each column, of lines of that column only."""
    cols, pos = (F.col("lines")[c] for c in ("cols", "pos"))
    n, first = F.size("lines"), F.get("lines", F.lit(0))
    of = of.where(F.size("lines") > 0).withColumn("cols", first["cols"])
    totals = F.filter("lines", lambda x: ~x["item"])["row_order"]
    alone = (F.size("cols") == 1) | (F.size(F.array_distinct("cols")) == F.size("cols")) & (F.size(F.array_distinct(totals)) == F.size(totals))
    of = of.withColumn("even", F.coalesce((cols == F.array_repeat("cols", n.cast("int"))) & (pos == F.array_repeat(first["pos"], n.cast("int"))) & alone, F.lit(False)))
    cell = lambda x, j: F.struct(*[F.array(F.get(x[c], j)).alias(c) if c in ("amts", "pos", "cols") else x[c].alias(c) for c in LINE])
    cells = F.sort_array(F.flatten(F.transform("lines", lambda x: F.transform(F.sequence(F.lit(0), F.size(x["cols"]) - 1), lambda j: cell(x, j)))))
    names = F.flatten(cols)
    single = lambda name, some: F.struct(F.array(name).alias("cols"), F.filter(some, lambda x: F.get(x["cols"], F.lit(0)).eqNullSafe(name)).alias("lines"))
    each = _let(F.when(F.size(names) == n, F.col("lines")).otherwise(cells), lambda some: F.transform(F.array_distinct(names), lambda name: single(name, some)))
    blocks = F.when(F.col("even"), F.array(F.struct("cols", "lines"))).otherwise(each)
    placed = lambda a: F.flatten(F.transform(a, lambda x: F.arrays_zip(x["cols"], x["pos"])))
    places = F.concat(placed(F.when(F.col("even"), F.slice("lines", 1, 1)).otherwise(F.col("lines"))), placed("headings"))
    of = of.withColumns({"blocks": blocks, "places": F.when(F.col("kind") == "SOA", F.array_distinct(places))})
    at = lambda name: F.array_min(F.filter("places", lambda p: p["cols"] == name)["pos"])
    of = of.withColumns({"lo": at("Total"), "hi": at("Component Units")})
    between = F.filter("places", lambda p: (p["pos"] > F.col("lo")) & (p["pos"] < F.col("hi")))["cols"]
    return of.withColumn("between", between).drop("lines", "headings", "cols", "even", "places", "lo", "hi")


def _gathered(rows: DataFrame) -> DataFrame:
    """One row for each total (doc_id, table_id, row_order, section, datapoint, sec, name): what its document is, and its table's blocks.

    rule_set is the statement's type; PROP_SNP with net assets, without net position and deferrals, is that of a nonprofit. between: the
    columns that stand strictly between Total and Component Units; null without both. blocks: (cols, lines) of its table.
    """
    s, flag, total = F.lower(F.trim("section")), F.col("flag"), F.col("flag") == "CP"
    of = {"sec": s, "item": flag == "DP", "name": F.lower(F.trim(F.coalesce("datapoint", F.lit("")))), "lab": F.lower(F.coalesce("label", F.lit(""))), "pos": F.col("col_pos"), "amts": F.col("amts").cast(f"array<{MONEY}>")}
    if rows.schema["amts"].dataType.containsNull:
        of["amts"] = F.transform("amts", lambda a: F.coalesce(a, F.lit(0)).cast(MONEY))
    of |= {c: F.when(total, F.col(c)) for c in ("section", "datapoint")}
    counted, heading = F.coalesce(total | (flag == "DP"), F.lit(False)), F.struct("cols", F.col("col_pos").alias("pos"))
    held = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    rows = rows.where(F.size("cols") > 0).select("doc_id", "stmt_type", "section", F.when(counted, F.struct(*[of.get(c, F.col(c)).alias(c) for c in LINE])).alias("line"), F.when(~counted, heading).alias("heading"))
    of = rows.groupBy("doc_id").agg(
        F.sort_array(F.collect_list("line")).alias("lines"), F.min("stmt_type").alias("kind"), F.collect_set("heading").alias("headings"),
        held(s == "net assets").alias("assets"), held((s == "net position") | s.contains("deferred outflows") | s.contains("deferred inflows")).alias("others"),
    )
    rule_set = F.when((F.col("kind") == "PROP_SNP") & F.col("assets") & ~F.col("others"), "PROP_SNP_NONPROFIT").otherwise(F.col("kind"))
    of = _blocks(of.select("doc_id", "kind", "lines", "headings", rule_set.alias("rule_set"), F.size(F.array_distinct(F.col("lines")["table_id"])).alias("tables")))
    sums = lambda b: F.transform(F.filter(b["lines"], lambda x: ~x["item"]), lambda x: F.struct(*[x[c].alias(c) for c in ("table_id", "row_order", "section", "datapoint", "sec", "name")]))
    of = of.withColumn("t", F.explode(F.array_distinct(F.flatten(F.transform("blocks", sums)))))
    own = F.transform("blocks", lambda b: F.struct(b["cols"].alias("cols"), F.filter(b["lines"], lambda x: x["table_id"].eqNullSafe(F.col("t.table_id"))).alias("lines")))
    return of.select("doc_id", "rule_set", "between", F.when(F.col("tables") == 1, F.col("blocks")).otherwise(own).alias("blocks"), "t.*")


def check_statements(rows: DataFrame) -> DataFrame:
    """check_lines for tidy rows."""
    named = {"cols": F.array("col"), "col_pos": F.array("col_pos"), "amts": F.array(F.coalesce(F.col("amt").cast(MONEY), F.lit(0).cast(MONEY)))}
    return check_lines(rows.select("doc_id", "stmt_type", "table_id", "section", "row_order", "flag", "label", "datapoint", *[v.alias(c) for c, v in named.items()]))


def check_lines(rows: DataFrame) -> DataFrame:
    """For lines, rows (doc_id, table_id, section, row_order, datapoint, status, formula) of all totals.

    status: PASS, the failing columns as `a: FAIL | b: FAIL` in their order, or Skipped. formula: which of the rule's sums or formulas
    counted, from 0. Of several rules for a total the last counts. Rules for blank names count in their section only; a schedule's rule
    for the first total of each section of a table only. Types in SELF_CHECKED come back with a null status.

    Rows are shuffled once, by document; from then on each total is judged in its own row, so nothing is sorted or moved again.
    """
    table = rules_table(rows.sparkSession)
    own, rest = table.where("rule_name <> '*'").withColumnRenamed("rules", "own"), table.where("rule_name = '*'").select(F.col("rule_of").alias("rest_of"), F.col("rules").alias("rest"))
    totals = _gathered(rows)
    totals = totals.join(F.broadcast(own), (F.col("rule_set") == F.col("rule_of")) & (F.col("name") == F.col("rule_name")), "left").join(F.broadcast(rest), F.col("rule_set") == F.col("rest_of"), "left")
    total = lambda x: ~x["item"]
    this = lambda x: total(x) & (x["row_order"] == F.col("row_order")) & x["section"].eqNullSafe(F.col("section")) & x["datapoint"].eqNullSafe(F.col("datapoint"))
    places = lambda b: F.sequence(F.lit(0), F.size(b["cols"]) - 1)
    entries = F.flatten(F.transform("blocks", lambda b: F.transform(F.filter(b["lines"], this), lambda x: F.struct(b["cols"].alias("cols"), places(b).alias("places"), x["pos"].alias("pos"), x["amts"].alias("reported"), b["lines"].alias("lines")))))
    first = F.array_min(F.flatten(F.transform("blocks", lambda b: F.filter(b["lines"], lambda x: total(x) & (x["sec"] == F.col("sec")))["row_order"])))
    ours = lambda b, j: F.transform(F.filter(b["lines"], total), lambda x: F.struct(x["row_order"].alias("row_order"), F.get(x["amts"], j).alias("amt")))
    premiums = F.array_max(F.flatten(F.transform("blocks", lambda b: F.transform(F.filter(places(b), lambda j: F.lower(F.trim(F.get(b["cols"], j))) == "premium/discount"), lambda j: ours(b, j)))))
    premium = F.get(F.filter(premiums, lambda p: p["row_order"] == F.col("row_order")), F.lit(0))["amt"]

    def candidate(rule: Column, e: Column, i: Column) -> Column:
        r = {c: rule[c] for c in ("contains", "excludes", "kind", "section")} | {c: F.col(c) for c in ("row_order", "sec", "premium")} | {c: e[c] for c in ("lines", "places", "cols", "reported")}
        return F.when(rule["kind"] == "chains", _formula(e["lines"], e["places"], F.get(rule["chains"], i))).otherwise(_sums(r, i))

    def formula(rule: Column, i: Column) -> Column:
        """What the i-th sum or formula says over all columns, as what is compared for the best."""
        off = lambda e, values, j: F.abs(F.get(values, j) - F.get(e["reported"], j)) > 1
        failing = lambda e, values: F.transform(F.filter(e["places"], lambda j: off(e, values, j)), lambda j: F.struct(F.get(e["pos"], j).alias("col_pos"), F.get(e["cols"], j).alias("col")))
        tried = F.transform("entries", lambda e: _let(candidate(rule, e, i), lambda c: F.struct(c["usable"].alias("usable"), failing(e, c["values"]).alias("fails"))))

        def judged(tried: Column, fails: Column) -> Column:
            rank = F.when(~F.forall(tried, lambda t: t["usable"]), 2).when((rule["pick"] == "match") & (F.size(fails) > 0), 1).otherwise(0)
            return F.struct(rank.alias("rank"), F.when(rule["pick"] == "more", F.size(fails)).otherwise(0).alias("more"), i.alias("formula"), fails.alias("fails"))

        return _let(tried, lambda t: _let(F.sort_array(F.flatten(t["fails"])), lambda fails: judged(t, fails)))

    def best(rule: Column) -> Column:
        """The best of a rule's sums or formulas; those after one that nothing later can beat aren't worked out."""
        none = F.lit(None).cast(f"struct<rank:int,more:int,formula:int,fails:array<struct<{', '.join(f'{c}:{rows.schema[of].dataType.elementType.simpleString()}' for c, of in (('col_pos', 'col_pos'), ('col', 'cols')))}>>>")
        return F.aggregate(F.sequence(F.lit(0), _tries(rule) - 1), none, lambda b, i: F.when((b["rank"] == 0) & (b["more"] == 0), b).otherwise(F.least(b, formula(rule, i))))

    def verdict(rule: Column) -> Column:
        counts = ((rule["kind"] != "blank") | (F.col("sec") == rule["section"])) & ((rule["kind"] != "schedule") | (F.col("row_order") == F.col("first")))
        skipped = lambda b: b["rank"] == 2
        said = lambda b: F.struct(rule["seq"].alias("seq"), skipped(b).alias("skipped"), b["fails"].alias("fails"), F.when(~skipped(b), b["formula"]).alias("formula"), rule["only"].alias("only"))
        return F.when(counts, _let(best(rule), said))

    rules = F.coalesce("own", "rest")
    schedule = F.exists(rules, lambda r: r["kind"] == "schedule")
    judged = totals.select(*TOTAL, "rule_set", "between", "sec", rules.alias("rules"), entries.alias("entries"), F.when(schedule, first).alias("first"), F.when(schedule, premium).alias("premium"))
    judged = judged.select(*TOTAL, "rule_set", "between", F.filter(F.transform("rules", verdict), lambda v: v.isNotNull()).alias("verdicts"))
    later = lambda v: v["only"] != "always"
    last = lambda test: F.array_max(F.filter("verdicts", test))
    both = judged.select(*TOTAL, "rule_set", "between", last(lambda v: ~later(v)).alias("a"), last(lambda v: later(v) & ~v["skipped"]).alias("z"), F.array_max(F.transform(F.filter("verdicts", later), lambda v: v["only"])).alias("only"))
    open_ = F.col("a").isNull() | F.col("a.skipped")
    again = F.col("z").isNotNull() & F.when(F.col("only") == "open", open_).otherwise(open_ | (F.size("a.fails") > 0))
    out = both.select(*TOTAL, "rule_set", "between", F.when(again, F.col("z")).otherwise(F.col("a")).alias("v"))
    fails = F.filter("v.fails", lambda f: ~F.exists(F.coalesce("between", F.array().cast("array<string>")), lambda c: F.concat(f["col"], F.lit(": FAIL")).contains(c)))
    fails = F.when(F.col("rule_set") == "SOA", fails).otherwise(F.col("v.fails"))
    status = F.when(F.col("rule_set").isin(SELF_CHECKED), F.lit(None)).when(F.col("v").isNull(), "Skipped - no rule defined").when(F.col("v.skipped"), "Skipped - no chain matched").when(F.size(fails) == 0, "PASS").otherwise(F.array_join(F.transform(fails, lambda f: F.concat(f["col"], F.lit(": FAIL"))), " | "))
    return out.select(*TABLE, "section", "row_order", "datapoint", status.alias("status"), "v.formula")
