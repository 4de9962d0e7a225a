"""Ordered label rules: which datapoint of a chart a statement's row belongs to.

Rules are data. All their phrases are compiled into one automaton, which reads a label once and gives the phrases it holds as a bitset; a rule
holds if it has a bit of each of its groups and none of its exclusions, and the first rule that holds counts. Labels are matched once each,
however many rows have them.

A label is folded to lower case, punctuation and runs of space become one space, `non current` one word. Phrases match from the start of a
word on. The part before the last colon is the label's prefix (its group's heading), the rest its suffix.

Cases: a null label is an empty one and falls to the last rule; a null flag or section matches only rules for any; ties can't occur, rules are
ordered; repeated rows are matched alike; a label of any length is read once; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Holds for the flag and section (None: any) if the label is one of `exact` (if given), its part holds a phrase of each group and none of
    `without`, and its prefix one of `under` (if given). stage: 1 before and 2 after the chart's own names are looked up."""

    name: str
    flag: str
    section: str | None
    outcome: str
    exact: tuple[str, ...] = ()
    groups: tuple[tuple[str, ...], ...] = ()
    without: tuple[str, ...] = ()
    under: tuple[str, ...] = ()
    part: str = "label"
    stage: int = 1


def _to(name: str, flag: str, section: str, table: str) -> list[Rule]:
    """Rules of whole labels, from lines `label | label = datapoint`."""
    rows = [line.rsplit(" = ", 1) for line in table.strip().splitlines()]
    return [Rule(f"{name}.{i + 1}", flag, section, outcome.strip(), exact=tuple(folded(x) for x in labels.split(" | "))) for i, (labels, outcome) in enumerate(rows)]


def _holds(name: str, flag: str, section: str, table: str, stage: int = 2, part: str = "suffix") -> list[Rule]:
    """Rules of phrases, from lines `phrase, phrase + phrase, phrase - excluded phrase = datapoint`."""
    out = []
    for i, line in enumerate(table.strip().splitlines()):
        left, outcome = line.rsplit(" = ", 1)
        left, _, without = left.partition(" -- ")
        split = lambda x: tuple(p.strip() for p in x.split(",") if p.strip())
        out.append(Rule(f"{name}{i}", flag, section, outcome.strip(), groups=tuple(split(g) for g in left.split(" + ")), without=split(without), part=part, stage=stage))
    return out


def folded(label: str) -> str:
    """The same as fold() on a value, without the colon."""
    import re

    return re.sub(r"\bnon current\b", "noncurrent", " ".join(re.sub(r"[^a-z0-9]+", " ", label.lower()).split()))


def fold(label: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(label, F.lit(""))), "[^a-z0-9]+", " "))
    return F.regexp_replace(plain, r"\bnon current\b", "noncurrent")


#: The rules of the statement of net position, in their order. Rules that an earlier one of the same words always precedes are left
#: out: compensated absences under noncurrent liabilities, a second tax receivable, plain receivables, and the last ones of deferred items.
POSITION_RULES = (
    [
        Rule("C8.1", "DP", "Assets", "Restricted Cash and Investments", groups=(("cash", "investment", "equity in central treasury", "deposit", "treasury", "pooled cash"),), under=("restricted", "temporarily restricted")),
        Rule("C8.2", "DP", "Assets", "Restricted Assets - Noncurrent", groups=(("noncurrent",),), under=("restricted", "temporarily restricted")),
        Rule("C8.3", "DP", "Assets", "Restricted Assets - Current", under=("restricted", "temporarily restricted")),
    ]
    + _to("C1", "DPG", None, """
Assets = Assets
Deferred Outflows of Resources = Deferred Outflows of Resources
Liabilities = Liabilities
Deferred Inflows of Resources = Deferred Inflows of Resources
Net Position = Net Position
""")
    + [Rule("C2.0", "CP", None, "", groups=(("fund balance",),))]
    + _to("C2", "CP", None, """
Total assets = Total Assets
Total current assets = Total Current Assets
Total other assets = Total Other Assets
Total capital assets | Capital assets - net = Total Capital Assets
Total noncurrent assets = Total Noncurrent Assets
Total deferred outflows of resources = Total Deferred Outflows of Resources
Total assets and deferred outflows of resources = Total Assets and Deferred Outflows of Resources
Total current liabilities = Total Current Liabilities
Total noncurrent liabilities = Total Noncurrent Liabilities
Total liabilities = Total Liabilities
Total deferred inflows of resources = Total Deferred Inflows of Resources
Total restricted = Total Restricted
Total unrestricted = Total Unrestricted
Total net position | Total net position (deficit) = Total Net Position
Total restricted assets = Total Restricted Assets
Deferred Inflows of Resources = Total Deferred Inflows of Resources
Deferred Outflows of Resources = Total Deferred Outflows of Resources
""")
    + _holds("C2.t", "CP", None, """
liab + deferred inflows + net position, net assets = Total Liabilities, Deferred Inflows of Resources, and Net Position
liab + deferred inflows = Total Liabilities and Deferred Inflows of Resources
""", 1, "label")
    + _to("C3", "DP", "Assets", """
Cash and investments | Cash and cash equivalents | Pooled cash | Cash and investments (including cash equivalents) = Cash and Investments
Restricted cash | Restricted cash and investments | Cash with Fiscal Agent | Cash held by fiscal agent | Cash held by trustee | Cash and Cash Equivalents in Segregated Accounts | Cash and Cash Equivalents with Fiscal Agent | Cash and investments: In custody of the County Treasurer = Restricted Cash and Investments
Receivables: Accounts receivable | Accounts receivable | Accounts receivable - net = Accounts Receivable
Receivables: Interest receivable = Interest Receivable
Receivables: Taxes receivable | Taxes receivable | Taxes receivable - succeeding year | Taxes receivable - subsequent year | Property tax receivable = Taxes Receivable
Receivables: Lease receivable | Leases receivable | Notes receivable | Bond bank receivable | Other receivable = Other Receivable
Internal balances | Due from component unit | Due from component units = Due from Other Funds
Due from other governments | Intergovernmental receivable = Due from Other Governments
Due from primary government = Due from Other Funds
Inventories | Inventory = Inventories
Prepaid items | Prepaid expenses | Prepaid = Prepaid items
Capital assets not being depreciated | Land | Construction in progress | Capital assets, net of accumulated depreciation | Capital assets, net of accumulated depreciation/amortization | Depreciable capital assets, net = Capital Assets
Noncurrent assets: Loans and notes | Noncurrent assets: Lease Receivable = Other Noncurrent Assets
Investment in associated companies | Investment in subsidiaries | Investment in joint ventures = Cash and Investments
Noncurrent assets: Investment in associated companies | Noncurrent assets: Investment in subsidiaries | Noncurrent assets: Investment in joint ventures = Other Noncurrent Assets
""")
    + [Rule("C4", "DP", "Deferred Outflows of Resources", "Deferred Outflows of Resources", groups=(("deferred outflow",),))]
    + _holds("C5.p", "DP", "Liabilities", """
pension, opeb, retirement, post employment, employee benefits, compensated absences, vested leave, sick leave + within one year, current = Payroll Liabilities - Current
pension, opeb, retirement, post employment, employee benefits, compensated absences, vested leave, sick leave + after one year, noncurrent = Payroll Liabilities - Noncurrent
""", 1, "label")
    + [
        Rule("C5.x", "DP", "Liabilities", "Other Liabilities - Noncurrent", exact=("long term liabilities payable", "other long term liabilities", "general long term obligations", "long term obligations"), part="suffix"),
        Rule("C5.n1", "DP", "Liabilities", "Long-term Debt - Noncurrent", groups=(("bonds payable", "notes payable", "revenue bonds", "revenue notes", "certificates of obligation", "leases payable", "capital leases", "installment purchases"), ("due within one year", "due after one year")), under=("noncurrent liabilities",)),
        Rule("C5.n2", "DP", "Liabilities", "Other Liabilities - Noncurrent", groups=(("long term liabilities payable", "other long term liabilities", "claims and judgments", "landfill closure", "general long term obligations"), ("due within one year", "due after one year")), under=("noncurrent liabilities",)),
    ]
    + _holds("C5.s", "DP", "Liabilities", """
bonds payable, notes payable, bonds notes payable, revenue notes, leases + within one year = Long-term Debt - Current
bonds payable, notes payable, bonds notes payable, revenue notes, leases + after one year = Long-term Debt - Noncurrent
""", 1, "label")
    + _to("C5", "DP", "Liabilities", """
Accrued landfill costs payable after one year | Landfill closure costs = Other Liabilities - Noncurrent
Accounts payable | Accounts and contracts payable | Accrued liabilities = Accounts Payable
Interest payable | Accrued interest = Interest Payable
Salaries and benefits payable | Salaries payable | Payroll payable | Accrued payroll = Payroll Liabilities - Current
Due to other governments | Due to other governmental units = Due to Other Governments
Due to primary government | Due to component unit | Interfund payable = Due to Other Funds
Deposits payable | Customer deposits = Other Liabilities - Current
Unearned revenue | Deferred revenue = Deferred Revenue
""")
    + _holds("C6.", "DP", "Deferred Inflows of Resources", "deferred inflow, taxes and assessments for subsequent years, taxes and assessments for succeeding year = Deferred Inflows of Resources", 1, "label")
    + [
        Rule("C7.0", "DP", "Net Position", "", groups=(("fund balance",),)),
        Rule("C7.1", "DP", "Net Position", "Net Investment in Capital Assets", exact=("net investment in capital assets",)),
        Rule("C7.2", "DP", "Net Position", "Restricted Net Assets", groups=(("restricted",),)),
        Rule("C7.3", "DP", "Net Position", "Unrestricted Net Assets", exact=("unrestricted",)),
    ]
    + _holds("A", "DP", "Assets", """
tax receivable = Taxes Receivable
cash, investment, deposit + fiscal agent, trustee, segregated + noncurrent, long term = Restricted Assets - Noncurrent
cash, investment, deposit + fiscal agent, trustee, segregated = Restricted Cash and Investments
restricted, held with, set aside + cash, treasury, investment, deposit = Restricted Cash and Investments
restricted, held with + lease, bond, long term, misc, other + noncurrent, long term = Restricted Assets - Noncurrent
investment + associated, subsidiar, joint venture, equity method = Cash and Investments
cash, treasury, investment, deposit = Cash and Investments
accounts receivable, trade receivable = Accounts Receivable
interest, fiscal, receivable = Interest Receivable
due from other government, due from other commonwealth, intergovernmental = Due from Other Governments
internal balances, inter fund, interfund, due from fund, due from component unit = Due from Other Funds
noncurrent, long term + loan, note, lease receivable, other receivable = Other Noncurrent Assets
due from = Other Receivable
inventor, suppli, stock, material = Inventories
prepaid = Prepaid Items
capital assets, land, plant, equipment, infrastructure, construction in progress = Capital Assets
other assets, bond issuance, long term, misc, other, for resale, pension, postemployment, post employment, opeb = Other Noncurrent Assets
""")
    + _holds("L", "DP", "Liabilities", """
salary, payroll, compensated absences, vested leave, sick leave, pension, postemployment, post employment, opeb + within one year, current = Payroll Liabilities - Current
salary, payroll, compensated absences, vested leave, sick leave, pension, postemployment, post employment, opeb + after one year, more than one year, noncurrent = Payroll Liabilities - Noncurrent
bonds, loans, notes, leases + within one year, current -- performance, mature = Long-term Debt - Current
bonds, loans, notes, leases + after one year, more than one year, noncurrent -- performance, mature, long term liabilities payable, other long term liabilities, general long term obligations = Long-term Debt - Noncurrent
accounts payable, trade payable = Accounts Payable
accrued interest, interest payable, interest, fiscal charges = Interest Payable
contract, retainage = Contract Payable
deposit, refundable, customer deposit = Deposit Payable
due to other government, due to commonwealth, intergovernmental = Due to Other Governments
due to other fund, inter fund, interfund, due to component unit = Due to Other Funds
unearned, deferred revenue = Deferred Revenue
accrued liabilities, overdraft, shortage, other payable, other, misc + within one year, current = Other Liabilities - Current
accrued liabilities, other payable, other, misc + after one year, more than one year, noncurrent = Other Liabilities - Noncurrent
payable from restricted asset + within one year, current = Liabilities Payable from Restricted Assets - Current
payable from restricted asset + after one year, noncurrent = Liabilities Payable from Restricted Assets - Noncurrent
""")
    + _holds("DI", "DP", "Deferred Inflows of Resources", "taxes and assessments = Deferred Inflows of Resources")
    + _holds("N", "DP", "Net Position", """
net investment = Net Investment in Capital Assets
unrestricted = Unrestricted Net Assets
""")
)


class Matcher:
    """The rules' phrases as one automaton, and each rule as bitsets."""

    def __init__(self, rules: list[Rule]):
        import ahocorasick

        self.rules, self.automaton, self.bit = rules, ahocorasick.Automaton(), {}
        for rule in rules:
            for phrase in [p for group in (*rule.groups, rule.without, rule.under) for p in group]:
                if phrase not in self.bit:
                    self.bit[phrase] = 1 << len(self.bit)
                    self.automaton.add_word(f" {phrase}", self.bit[phrase])
        if self.bit:
            self.automaton.make_automaton()
        mask = lambda phrases: sum(self.bit[p] for p in set(phrases))
        self.by: dict[tuple[int, str], list] = {}
        for place, r in enumerate(rules):
            self.by.setdefault((r.stage, r.flag), []).append((place, r.section, set(r.exact), [mask(g) for g in r.groups], mask(r.without), mask(r.under), r.part))

    def held(self, text: str) -> int:
        return sum({bit for _, bit in self.automaton.iter(f" {text}")}) if self.bit and text else 0

    def first(self, stage: int, flag: str | None, section: str | None, prefix: str, suffix: str, label: str) -> int | None:
        """The place of the first rule that holds."""
        bits = {"label": self.held(label), "suffix": self.held(suffix)}
        above, text = self.held(prefix), {"label": label, "suffix": suffix}
        for place, wanted, exact, groups, without, under, part in self.by.get((stage, flag), ()):
            if (wanted is None or wanted == section) and (not exact or text[part] in exact) and all(bits[part] & g for g in groups) and not bits[part] & without and (not under or above & under):
                return place
        return None


def matched(rules: list[Rule]):
    """For mapInArrow over (flag, section, prefix_, suffix_, label_): the names and outcomes of the first rules of both stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(rules)
        for batch in batches:
            rows = list(zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True))
            found = [[matcher.first(stage, *row) for row in rows] for stage in (1, 2)]
            named = [pa.array([None if p is None else getattr(rules[p], what) for p in places], pa.string()) for places in found for what in ("name", "outcome")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *named], ["flag", "section", "prefix_", "suffix_", "label_", "rule_", "first_", "later_rule_", "later_"])

    return run


def datapoints(rows: DataFrame, chart: DataFrame, rules: list[Rule] = POSITION_RULES) -> DataFrame:
    """Rows (flag, section, label, ..) with `datapoint` and `rule`, the name of what decided.

    In order: the rules of stage 1, the chart's own name (flag, section, datapoint) for the whole label, then for its suffix, of the same section
    if there is one, the rules of stage 2, and last `Other_<section>` for DP, `Other_DPG` for DPG and nothing for CP. A rule without an outcome
    leaves the datapoint empty on purpose.
    """
    text = F.coalesce("label", F.lit(""))
    parts = F.split(text, ":")
    suffix = fold(F.element_at(parts, -1))
    prefix = fold(F.array_join(F.slice(parts, 1, F.size(parts) - 1), " "))
    keyed = rows.withColumns({"prefix_": prefix, "suffix_": suffix, "label_": fold(text)})
    labels = keyed.select("flag", "section", "prefix_", "suffix_", "label_").distinct()
    kinds = "flag string, section string, prefix_ string, suffix_ string, label_ string, rule_ string, first_ string, later_rule_ string, later_ string"
    labels = labels.mapInArrow(matched(rules), kinds)
    names = chart.where("flag is not null").select(F.col("flag").alias("f_"), F.col("section").alias("s_"), fold(F.col("datapoint")).alias("n_"), F.col("datapoint").alias("d_"))
    own = names.groupBy("f_", "n_", "s_").agg(F.min("d_").alias("d_"))
    any_ = names.groupBy("f_", "n_").agg(F.min("d_").alias("d_"))
    for column in ("label_", "suffix_"):
        same = own.select(F.col("f_").alias("flag"), F.col("s_").alias("section"), F.col("n_").alias(column), F.col("d_").alias(f"{column}own"))
        other = any_.select(F.col("f_").alias("flag"), F.col("n_").alias(column), F.col("d_").alias(f"{column}any"))
        labels = labels.join(same, ["flag", "section", column], "left").join(other, ["flag", column], "left")
    last = F.when(F.col("flag") == "DP", F.concat(F.lit("Other_"), F.regexp_replace(F.coalesce("section", F.lit("")), " ", "_"))).when(F.col("flag") == "DPG", "Other_DPG").otherwise("")
    point = F.coalesce("first_", "label_own", "label_any", "suffix_own", "suffix_any", "later_", last)
    rule = F.when(F.col("rule_").isNotNull(), F.col("rule_")).when(F.coalesce("label_own", "label_any").isNotNull(), "chart").when(F.coalesce("suffix_own", "suffix_any").isNotNull(), "suffix").otherwise(F.coalesce("later_rule_", F.lit("last")))
    decided = labels.select("flag", "section", "prefix_", "suffix_", "label_", point.alias("datapoint"), rule.alias("rule"))
    keys = ["flag", "section", "prefix_", "suffix_", "label_"]
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    rest = [c for c in rows.columns if c not in ("datapoint", "rule")]
    return keyed.alias("l").join(decided.alias("r"), on, "left").select(*[F.col(f"l.{c}") for c in rest], "r.datapoint", "r.rule")
