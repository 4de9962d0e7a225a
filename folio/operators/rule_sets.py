"""The rules by which a statement's totals are checked, as a table: one row for each total name and statement type.

A rule of sums says which items a total adds up. A rule of chains lists formulas in order; a formula adds its members, and a
member is the first of its sources that is there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

#: Statement types whose totals were checked when they were read; they have no rules here.
SELF_CHECKED = ["CAPITAL_ASSETS", "TAX_BASE", "OVERVIEW", "PEN", "OPEB", "FAQS"]


@dataclass(frozen=True)
class Source:
    """kind: total (last of that name, else the first shorter name within it), exact (last of that name), section (sum of its items),
    item (first of that name) or items (sum of all of that name)."""

    kind: str
    name: str = ""
    section: str | None = None


@dataclass(frozen=True)
class Member:
    sources: tuple[Source, ...]
    required: bool = False
    sign: int = 1


@dataclass(frozen=True)
class Rule:
    """pick: of chains the first usable one, or first one that matches all columns, or the one that matches most. when: always, or only
    where the rules before left the total open or not passed."""

    name: str
    kind: str
    section: str | None = None
    contains: tuple[str, ...] = ()
    excludes: tuple[str, ...] = ()
    chains: tuple[tuple[Member, ...], ...] = field(default=())
    pick: str = "first"
    when: str = "always"


def total(name: str, sign: int = 1, required: bool = False) -> Member:
    return Member((Source("total", name),), required, sign)


def need(name: str, sign: int = 1) -> Member:
    return total(name, sign, True)


def total_or_section(name: str, section: str) -> Member:
    return Member((Source("total", name), Source("section", section=section)))


def sums(name: str, kind: str, section: str | None, contains: list[str] = (), excludes: list[str] = ()) -> Rule:
    pick = "more" if kind == "section" and excludes else "match"
    return Rule(name, kind, section, tuple(c.lower() for c in contains), tuple(e.lower() for e in excludes), pick=pick)


def chains(name: str, *formulas: list[Member], pick: str = "first", when: str = "always") -> Rule:
    return Rule(name, "chains", chains=tuple(tuple(f) for f in formulas), pick=pick, when=when)


# Fixed values from here on: names of totals, sections and label parts.
OUTFLOWS = "Total Deferred Outflows of Resources", "Deferred Outflows of Resources"
INFLOWS = "Total Deferred Inflows of Resources", "Deferred Inflows of Resources"
ASSETS_AND_OUTFLOWS = chains(
    "Total Assets and Deferred Outflows of Resources",
    [need("Total Assets"), total_or_section(*OUTFLOWS)],
    [need("Total Current Assets"), need("Total Noncurrent Assets"), total_or_section(*OUTFLOWS)],
    pick="match",
)
LIABILITIES_AND_INFLOWS = chains(
    "Total Liabilities and Deferred Inflows of Resources",
    [need("Total Liabilities"), need(INFLOWS[0])],
    [need("Total Liabilities"), total_or_section(*INFLOWS)],
    pick="match",
)


def all_of_it(name: str) -> Rule:
    return chains(
        name,
        [need("Total Liabilities"), need(INFLOWS[0])],
        [need("Total Liabilities"), total_or_section(*INFLOWS)],
        [need("Total Liabilities and Deferred Inflows of Resources"), need("Total Net Position")],
        [need("Total Liabilities"), need(INFLOWS[0]), need("Total Net Position")],
        [need("Total Liabilities"), total_or_section(*INFLOWS), total_or_section("Total Net Position", "Net Position")],
        pick="match",
    )


CURRENT = sums("Total Current Assets", "labels_not_start", "Assets", ["current assets"], ["noncurrent", "non-current"])
RESTRICTED = sums("Total Restricted Assets", "labels_since_total", "Assets", ["restricted assets"])
OTHER = sums("Total Other Assets", "labels_since_total", "Assets", ["other assets"])
NONCURRENT = sums("Total Noncurrent Assets", "labels", "Assets", ["noncurrent assets", "non-current assets"])
NET_CAPITAL = sums("Net Capital Assets", "labels_not_start", "Assets", ["capital assets"])
CAPITAL = sums("Total Capital Assets", "names", "Assets", ["Capital Assets"])
ASSETS = sums("Total Assets", "section", "Assets")
LIABILITIES = sums("Total Liabilities", "section", "Liabilities")
CURRENT_LIABILITIES = sums("Total Current Liabilities", "current_liabilities", "Liabilities")
NONCURRENT_LIABILITIES = sums("Total Noncurrent Liabilities", "labels_not_start", "Liabilities", ["noncurrent liabilities", "non-current liabilities", "long-term liabilities", "long-term liabil"], ["current liabilities:"])
DEFERRED = [sums(name, "section", section) for name, section in (OUTFLOWS, INFLOWS)]
REVENUES, EXPENSES = "Total Operating Revenues", "Total Operating Expenses"
SOURCES = "Total Other Financing Sources", "Other Financing Sources (Uses)"
EXCESS = "Excess Of Revenues Over/Under Expenditures"
TRANSFERS = "Total contributions and transfers", "Contributions and Transfers"
OPERATING, NONOPERATING = "Operating Income (Loss)", "Total Nonoperating Revenues/Expense"
FLOWS = ["Operating Activities", "Noncapital Financing Activities", "Capital and Related Financing Activities", "Investing Activities"]
RECEIPTS = ["Charges for Services", "Operating Grants and Contributions", "Capital Grants and Contributions"]
BALANCE = "Balance of Cash and Cash Equivalents"
NET_CHANGE = "Net Change in Cash and Cash Equivalents"

RULES: dict[str, list[Rule]] = {
    "PROP_SNP": [
        sums("Total Current Assets", "labels_positional", "Assets", ["current assets"], ["noncurrent", "non-current"]),
        RESTRICTED, OTHER, NET_CAPITAL, CAPITAL, NONCURRENT, ASSETS, DEFERRED[0], ASSETS_AND_OUTFLOWS,
        CURRENT_LIABILITIES, NONCURRENT_LIABILITIES, LIABILITIES, DEFERRED[1], LIABILITIES_AND_INFLOWS,
        sums("Total Net Position", "section", "Net Position", excludes=["adjustment"]),
        all_of_it("Total Liabilities, Deferred Inflows of Resources, and Net Position"),
    ],
    "PROP_SNP_NONPROFIT": [
        ASSETS, CAPITAL, LIABILITIES,
        sums("Total Net Assets", "section", "Net Assets"),
        sums("Total Net Position", "section", "Net Assets"),
        all_of_it("Total Liabilities, Deferred inflows of resources, and Net position"),
    ],
    "SNP": [
        CURRENT, RESTRICTED, OTHER, NET_CAPITAL, CAPITAL, NONCURRENT, ASSETS, DEFERRED[0], ASSETS_AND_OUTFLOWS,
        CURRENT_LIABILITIES, NONCURRENT_LIABILITIES, LIABILITIES, DEFERRED[1], LIABILITIES_AND_INFLOWS,
        sums("Total Restricted", "labels_not_start", "Net Position", ["restricted"], ["unrestricted"]),
        chains("Total Net Position", [
            Member((Source("item", "Net Investment in Capital Assets", "Net Position"),)),
            Member((Source("total", "Total Restricted"), Source("items", "Restricted Net Assets", "Net Position"))),
            Member((Source("item", "Unrestricted Net Assets", "Net Position"),)),
        ]),
        all_of_it("Total Liabilities, Deferred inflows of resources, and Net position"),
        sums("", "blank", "Net Position"),
    ],
    "GOV_BS": [
        CURRENT, sums("Total Net Position", "section", "Net Position"), RESTRICTED, OTHER, NONCURRENT, NET_CAPITAL, CAPITAL, ASSETS,
        DEFERRED[0], ASSETS_AND_OUTFLOWS, CURRENT_LIABILITIES, NONCURRENT_LIABILITIES, LIABILITIES, DEFERRED[1], LIABILITIES_AND_INFLOWS,
        sums("Total Fund Balances", "section", "Fund Balances"),
        chains("Total Liabilities, Deferred Inflows of Resources, And Fund Balances", [total_or_section("Total Liabilities", "Liabilities"), total_or_section(*INFLOWS), total_or_section("Total Fund Balances", "Fund Balances")]),
    ],
    "GOV_IS": [
        sums(REVENUES, "section", "Revenues"),
        sums(EXPENSES, "section", "Expenditures"),
        chains(EXCESS, [total(REVENUES), total(EXPENSES, -1)]),
        sums(SOURCES[0], "section", SOURCES[1]),
        chains("Net Change In Fund Balances", [need(EXCESS), total_or_section(*SOURCES)], [total_or_section(REVENUES, "Revenues"), total_or_section(*SOURCES)], pick="match"),
        chains("Net Change In Fund Balances", [need(EXCESS), total_or_section(*SOURCES)], [need(REVENUES), need(EXPENSES, -1), total_or_section(*SOURCES)], when="not passed"),
    ],
    "SOA": [
        sums("Total General Revenues", "section", "General Revenues", excludes=["transfers"]),
        chains("Total General Revenues and Transfer", [need("Total General Revenues"), Member((Source("items", "Transfers", "General Revenues"),))], [Member((Source("section", section="General Revenues"),))]),
        sums("Total Revenues", "section", "Revenues"),
        sums("Total Expenditures", "section", "Expenditures"),
        chains("Excess of Revenues Over Expenditures", [total("Total Revenues"), total("Total Expenditures", -1)]),
        *[sums(f"Total Program Receipts - {r}", "names", "Program Revenue", [r]) for r in RECEIPTS],
        sums("Total Program Expenses", "section", "Program Expenses"),
        chains("Changes in Net Position", [
            Member((Source("exact", "Total General Revenues and Transfer"), Source("exact", "Total General Revenues"), Source("total", "Total General Revenues and Transfer"))),
            *[total(f"Total Program Receipts - {r}") for r in RECEIPTS],
            total("Total Program Expenses", -1),
        ]),
    ],
    "PROP_IS": [
        sums(REVENUES, "rolling", "Operating Revenues"),
        sums(EXPENSES, "section", "Operating Expenses"),
        chains(OPERATING, [total_or_section(REVENUES, "Operating Revenues"), total(EXPENSES, -1)]),
        sums(NONOPERATING, "section", "Nonoperating Revenues (Expenses)"),
        chains("Change In Net Position", [need("Income (Loss) before Transfers"), total_or_section(*TRANSFERS)], [need("Income (Loss) before Transfers")], [need(OPERATING), need(NONOPERATING)], [need(OPERATING), total_or_section(*TRANSFERS)], pick="match"),
        sums("", "blank", "Contributions and Transfers"),
        chains("Change In Net Position", [need(REVENUES), need(EXPENSES, -1)], when="open"),
    ],
    "PROP_CFS": [
        *[sums(f"Total Cash Flows from {f}", "section", f"Cash Flows from {f}") for f in FLOWS],
        chains(NET_CHANGE, [
            *[total(f"Total Cash Flows from {f}") for f in FLOWS[:3]],
            Member((Source("total", f"Total Cash Flows from {FLOWS[3]}"), Source("items", f"Cash Flows from {FLOWS[3]}", f"Cash Flows from {FLOWS[3]}"))),
        ]),
        chains(f"Total {BALANCE}", [
            Member((Source("section", section=BALANCE), Source("section", section=f"Total Cash Flows from {FLOWS[0]}"), Source("section", section="Cash and Cash Equivalents"))),
            Member((Source("total", NET_CHANGE), Source("total", f"Total Cash Flows from {FLOWS[0]}"), Source("total", "Cash and Cash Equivalents"))),
        ]),
    ],
    "DSR": [sums("Total", "section", None), sums("*", "schedule", None)],
}
