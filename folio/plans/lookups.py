"""Queries of the readings of dates, names, pages and prices, over values made from the tables' keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions import dates, names
from folio.plans.catalogue import query, read


def pick(values: list, key):
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def sql(values: list, key: str) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values) + f"][1 + {key} % {len(values)}]"


CELLS = {"6/30/2024": (6, 2024), "FYE: 06-30-24": (6, 2024), "2023-12-31": (12, 2023), "Fiscal Year End August 31, 2025": (8, 2025), "30 Sept. 2022": (9, 2022), "45900": (8, 2025), "2025": None, "13/45/2020": None, "June 30": None, "": None, "1/1/1985": None, "12345": None}
_CELL = ", ".join(f"({k}, " + ("NULL, NULL)" if v is None else f"{v[0]}, {v[1]})") for k, v in enumerate(CELLS.values()))


@query(f"WITH v(i, fye_month, fye_year) AS (VALUES {_CELL}) SELECT c_custkey, CAST(fye_month AS INT) AS fye_month, CAST(fye_year AS INT) AS fye_year FROM customer JOIN v ON c_custkey % {len(CELLS)} = i")
def fiscal_year_end(spark, sf_dir):
    end = dates.year_end(pick(list(CELLS), F.col("c_custkey")), F.lit(2029))
    return read(spark, sf_dir, "customer").select("c_custkey", end["month"].alias("fye_month"), end["year"].alias("fye_year"))


_K = "c_custkey"


@query(f"""
WITH e AS (SELECT {_K}, {_K} % 12 + 1 AS m, 2020 + {_K} % 4 AS y, CASE WHEN {_K} % 5 > 0 THEN 2020 + {_K} % 3 END AS ay, CASE WHEN {_K} % 7 > 0 THEN 2020 + {_K} % 4 END AS fy FROM customer),
n AS (SELECT *, CASE WHEN ay IS NULL THEN 'AS IS' WHEN ay > coalesce(fy, y) THEN 'ADVANCED' WHEN ay < coalesce(fy, y) THEN 'RETRACTED' WHEN y <> ay THEN 'CORRECTED' ELSE 'OK' END AS note FROM e),
r AS (SELECT *, CAST(CASE WHEN note IN ('AS IS', 'OK') THEN y ELSE ay END AS INT) AS year FROM n)
SELECT {_K}, year, note, lpad(m::VARCHAR, 2, '0') || '/' || day(last_day(make_date(year, m, 1))) AS closing, CASE WHEN y = 2021 AND m = 6 THEN 'EXACT' WHEN m = 6 THEN 'MONTH' WHEN y = 2021 THEN 'YEAR' ELSE 'NONE' END AS match FROM r
""")
def year_reconciled(spark, sf_dir):
    k = F.col(_K)
    end = F.struct((k % 12 + 1).cast("int").alias("month"), (2020 + k % 4).cast("int").alias("year"))
    rows = read(spark, sf_dir, "customer").select(_K, end.alias("e"), dates.reconcile(end, F.when(k % 5 > 0, 2020 + k % 3), F.when(k % 7 > 0, 2020 + k % 4)).alias("r"))
    wanted = F.struct(F.lit(6).alias("month"), F.lit(2021).alias("year"))
    return rows.select(_K, F.col("r.year").alias("year"), F.col("r.note").alias("note"), dates.month_day(F.col("r"), F.lit(None).cast("int")).alias("closing"), dates.compare(wanted, F.col("e")).alias("match"))


LINES = {"As of June 30, 2023 and 2022": "2023-6", "For the years ended 6/30/2021 and June 30, 2022": "2022-6", "December 31, 2020 / 12.31.2019": "2020-12", "no date 13/13/2020": None, None: None, "1st January 2024, then 2 Feb 2024": "2024-2"}


@query(f"SELECT c_custkey, {sql(list(LINES.values()), _K)} AS latest FROM customer")
def latest_date_of_line(spark, sf_dir):
    best = F.get(dates.line_dates(pick(list(LINES), F.col(_K))), F.lit(0))
    return read(spark, sf_dir, "customer").select(_K, F.concat(best["year"].cast("string"), F.lit("-"), best["month"].cast("string")).alias("latest"))


WRITTEN_STATES = {"texas": "TX", "New York": "NY", " ca ": "CA", "Ontario": "ON", "": "", "DISTRICT OF COLUMBIA": "DC"}
FIRMS = {"Müller & Co., LLP (Ann Lee)": ("muller &", "Ann Lee"), "Smith P.C.": ("smith p c", ""), "Jones P.C. of Ohio": ("jones p c of ohio", ""), "Hill PLLC, CPAs": ("hill", ""), "A Professional Corporation of Jones": ("of jones", ""), "": ("", ""), "BIG-FOUR (x) LLC": ("big four x llc", "")}


@query(f"SELECT c_custkey, {sql(list(WRITTEN_STATES.values()), _K)} AS state, {sql([f[0] for f in FIRMS.values()], _K)} AS firm, {sql([f[1] for f in FIRMS.values()], _K)} AS contact FROM customer")
def state_and_firm(spark, sf_dir):
    k, parts = F.col(_K), names.firm_and_contact(pick(list(FIRMS), F.col(_K)))
    return read(spark, sf_dir, "customer").select(_K, names.state_code(pick(list(WRITTEN_STATES), k)).alias("state"), names.auditor_name(parts["firm"]).alias("firm"), parts["contact"].alias("contact"))


ENTITIES = {"The City of Austin d/b/a Austin Water, Inc.": "city austin water", "Café Authority No. 12 a.k.a. Cafe": "cafe authority no", "  ": "", "County 2024 & County": "county"}
STATE_LINES = {"City of Dallas, Texas": (True, True), "the city in Texas was founded": (True, False), "AUSTIN TX": (True, True), "Austin tx": (False, False), "A B C D E F G H I Texas": (True, False), "TEXAS": (True, True)}


@query(f"SELECT c_custkey, {sql(list(ENTITIES.values()), _K)} AS tokens, {sql([v[0] for v in STATE_LINES.values()], _K)} AS held, {sql([v[1] for v in STATE_LINES.values()], _K)} AS only FROM customer")
def entity_and_state_lines(spark, sf_dir):
    k = F.col(_K)
    line = pick(list(STATE_LINES), k)
    return read(spark, sf_dir, "customer").select(_K, F.array_join(names.entity_tokens(pick(list(ENTITIES), k)), " ").alias("tokens"), names.has_state(line, "TX", "Texas").alias("held"), names.names_state_only(line, "TX", "Texas").alias("only"))


PAGES = {"71,72, 73": ("_p71-72-73", [72, 74]), "9": ("_p9", [10, 12]), "3, x, 1": ("_p1-3", [3, 5]), "": (None, [2, 4])}


@query(f"SELECT c_custkey, {sql([v[0] for v in PAGES.values()], _K)} AS suffix, {sql([v[1][0] for v in PAGES.values()], _K)} AS second, {sql([v[1][1] for v in PAGES.values()], _K)} AS fourth FROM customer")
def page_translation(spark, sf_dir):
    pages = names.page_numbers(pick(list(PAGES), F.col(_K)))
    return read(spark, sf_dir, "customer").select(_K, F.when(F.size(pages) > 0, names.pages_suffix(pages)).alias("suffix"), names.original_page(pages, F.lit(2)).alias("second"), names.original_page(pages, F.lit(4)).alias("fourth"))


TEXTS = {'{"a": 1}': '{"a": 1}', 'Here:\n```json\n{"a": 2}\n```\nDone': '{"a": 2}', 'so {"a": {"b": 3}} it is': '{"a": {"b": 3}}', "nothing": None, "{broken": None}
URLS = {"https://x.org/a": "https://x.org/a", "2024-06-GSA-1": "https://base/dissemination/report/pdf/2024-06-GSA-1", " ": None}
YEARS = {"2024": 2024, "1899": None, "x": None, "2023.0": 2023, "3000": None}
OPINIONS = {"presents fairly, in all": "Present Fairly", "an Unqualified opinion": "Unqualified", "qualified": "Qualified", "Adverse": "Adverse", "does not present fairly": "Does Not Present Fairly"}


@query(f"""
SELECT c_custkey, {sql(list(TEXTS.values()), _K)} AS json, {sql(list(URLS.values()), _K)} AS url, CAST({sql(list(YEARS.values()), _K)} AS INT) AS year, {sql(list(OPINIONS.values()), _K)} AS opinion,
 CASE WHEN {_K} % 4 = 2 THEN 'NON-LG' ELSE 'LG' END AS sector FROM customer
""")
def small_readings(spark, sf_dir):
    k = F.col(_K)
    return read(spark, sf_dir, "customer").select(_K, names.json_in(pick(list(TEXTS), k)).alias("json"), names.filing_url(pick(list(URLS), k), "https://base").alias("url"), names.year_or_null(pick(list(YEARS), k)).alias("year"), names.opinion_label(pick(list(OPINIONS), k)).alias("opinion"), names.sector_of(k % 4).alias("sector"))


@query("""
SELECT conv_id, turn, round(0.5 * (greatest(0, length(text) - turn * 10) * 2.5 + turn * 10 * 0.25 + length(text) * 10) / 1000000, 9) AS cost FROM conversations WHERE text IS NOT NULL
""")
def token_costs(spark, sf_dir):
    """Batch prices with a cached part of the prompt."""
    n = F.length("text")
    cost = names.token_cost(n, n, F.lit(2.5), F.lit(10.0), F.col("turn") * 10, F.lit(0.25), batch=0.5)
    return read(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.round(cost, 9).alias("cost"))


@query("SELECT p_partkey, list_filter([trim(x) FOR x IN string_split(p_name || '==T==' || p_type || '==T== ==T==' || p_brand, '==T==')], lambda x: x <> '')::VARCHAR AS parts, regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9.-]+', '_', 'g'), '^_+|_+$', '', 'g')[1:34] AS stem FROM part")
def split_tables(spark, sf_dir):
    whole = F.concat_ws("==T==", "p_name", "p_type", F.lit(" "), "p_brand")
    parts = F.concat(F.lit("["), F.array_join(names.tables_in(whole, "==T=="), ", "), F.lit("]"))
    return read(spark, sf_dir, "part").select("p_partkey", parts.alias("parts"), names.file_stem(F.col("p_name")).alias("stem"))
