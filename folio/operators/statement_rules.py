"""Rules over single statements: lost digits, values in the wrong column, coverage, shares, kinds of debt."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a debt label holds, in the order in which the kinds are tried. Labels are compared as `debt_label` writes them.
PREMIUM = ["unamortized", "premium", "discount", "deferred loss on refunding", "deferred charge on refunding"]
PENSION = ["pension", "opeb", "other post employment", "other postemployment", "post employment", "post retirement", "postretirement"]
LEASE = ["sbita", "subscription", "installment purchase", "finance purchase", "financing purchase", "right to use", "rou asset", "rou liability"]
STATE = ["state loan", "state revolving fund", "srf loan", "state revolving loan", "state infrastructure bank", "state aid anticipation", "state assistance loan"]
DEBT = ["bond", "cabs", "capital appreciation", "loan", "note", "certificates of participation", "commercial paper", "direct placement", "direct borrowing"]
LIABILITY = ["compensated absence", "claims", "judgment", "judgement", "landfill", "closure", "arbitrage", "workers compensation", "termination benefits", "due to other government", "other liabilities", "noncurrent accounts payable", "interfund", "service agreement", "retirement payable"]


def debt_label(c: Column) -> Column:
    """Lower case without footnote marks and 'see note' references; punctuation other than apostrophes is a space."""
    text = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s*-\s*see note.*$", "")
    text = F.regexp_replace(F.regexp_replace(text, r"(\s*(\*|\([0-9]+\)))+\s*$", ""), "['’]", "")
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def debt_class(label: Column, ending: Column, due: Column) -> Column:
    """The kind of a debt item, or null. An ending balance that isn't 0 and is all due within a year makes it short-term."""
    text = debt_label(label)
    holds = lambda words: text.rlike("|".join(words))
    short = F.coalesce((ending != 0) & (ending == due), F.lit(False))
    debt = F.when(short, "Short-term Debt").otherwise("Long-term Debt")
    liability = F.when(short, "Short-term Liability").otherwise("Long-term Liability")
    leased = holds(LEASE) | (text.contains("lease") & (~holds(["bond", "debt"]) | text.contains("note")))
    return (
        F.when(holds(PREMIUM), "Premium/ Discount")
        .when(holds(PENSION), "Pension-OPEB Liability")
        .when(leased, "Lease Liability")
        .when(holds(STATE) | (text.rlike(r"\bstate\b") & text.contains("loan")), "State Loan")
        .when(text.contains("interfund"), liability)
        .when(holds(DEBT) | text.rlike(r"\bcops?\b"), debt)
        .when(holds(LIABILITY), liability)
    )


def digit_drop(value: Column, total: Column) -> Column:
    """A struct (value, state) for a written total and the sum of its items.

    ok: within a fifth of the sum, accepted as it is. repaired: the one number that a single added digit makes and that
    equals the sum within 1. fail: none or several such numbers, or a value with a fraction; the value stays. Null if
    either is null.
    """
    near = value.between(F.least(total * F.lit(Decimal("0.8")), total * F.lit(Decimal("1.2"))), F.greatest(total * F.lit(Decimal("0.8")), total * F.lit(Decimal("1.2"))))
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(Decimal(10) ** 30))
    digits = F.abs(value).cast("decimal(38,0)").cast("string")
    signed = lambda x: F.when(value < 0, -x).otherwise(x).cast("decimal(38,4)")
    # Only the two or three whole numbers within 1 of the sum are tried: one with a digit more than the value comes from it by adding
    # one if a single insertion parts the two; a zero put before the value leaves it as it is, and a 0 may become any single digit.
    # Amounts keep their type: beside a decimal(38,0) Spark would round them.
    lowest, fits = F.ceil(signed(total) - 1).cast("decimal(38,4)"), []
    for k in range(3):
        x = (lowest + k).cast("decimal(38,4)")
        text = x.cast("decimal(38,0)").cast("string")
        made = (x == F.abs(value)) | ((F.length(text) == F.length(digits) + 1) & (F.levenshtein(digits, text, 1) == 1)) | ((value == 0) & (x < 10))
        fits.append(F.when((x >= 0) & (x - signed(total) <= 1) & made, x))
    fixed = F.when(~near, whole & (sum(f.isNotNull().cast("int") for f in fits) == 1))
    state = F.when(near, "ok").when(fixed, "repaired").otherwise("fail")
    kept = F.when(fixed, signed(F.coalesce(*fits))).otherwise(value).cast("decimal(38,4)")
    return F.when(value.isNotNull() & total.isNotNull(), F.struct(kept.alias("value"), state.alias("state")))


def roll_forward(beginning: Column, additions: Column, deletions: Column, ending: Column, transfers: Column | None = None) -> Column:
    """Whether the beginning and its changes make the ending within 1; a missing amount counts as 0."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    changes = zero(beginning) + zero(additions) + zero(deletions) + (zero(transfers) if transfers is not None else F.lit(0))
    return F.abs(changes - zero(ending)) <= 1


def debt_coverage(funds: DataFrame, by: list[str]) -> DataFrame:
    """Adds coverage: (operating_income + depreciation + investment_income) / (principal + interest) of each fund, and
    adds low: whether any fund of the group covers less than 1. A fund with a missing operand or nothing to pay has null
    coverage and doesn't count; a group of such funds only isn't low. The groups' answers come back by a join.
    """
    paid = F.col("principal") + F.col("interest")
    earned = F.col("operating_income") + F.col("depreciation") + F.col("investment_income")
    out = funds.withColumn("coverage", F.when(paid != 0, earned.cast("double") / paid.cast("double")))
    low = out.groupBy(*by).agg(F.coalesce(F.bool_or(F.col("coverage") < 1), F.lit(False)).alias("low"))
    return out.join(low, by)


def weighs_on_fund(change: Column, fund_change: Column, share: float = 0.2) -> Column:
    """A loss of at least a share of the general fund's change."""
    return F.coalesce((change < 0) & (F.abs(change) >= F.abs(fund_change) * share), F.lit(False))


def activity_shares(governmental: Column, business: Column, primary: Column, units: Column) -> Column:
    """A struct (governmental, business, units) of shares that sum to 1; null without a basis; missing units count as 0."""
    both, cu = (governmental + business).cast("double"), F.coalesce(units, F.lit(0))
    whole = (primary + cu).cast("double")
    pg = primary.cast("double") / whole
    parts = F.struct((pg * governmental.cast("double") / both).alias("governmental"), (pg * business.cast("double") / both).alias("business"), (cu.cast("double") / whole).alias("units"))
    return F.when((both != 0) & (whole != 0), parts)


def repair_shifts(rows: DataFrame) -> DataFrame:
    """Moves values that stand in the wrong one of two addend columns; adds moved.

    rows: table_id, section, row_order, flag, label, a, b, total (decimals; null is blank). An item with just one addend,
    equal to its total, moves to the other column if that makes both columns of a 'total' row agree at once. The totals
    are taken in order, each with at most one move, and each sees what the earlier ones moved: so a section is one array,
    as long as a section of one statement is. Rows of one row_order go by their values.
    """
    kept = ["table_id", "section", "row_order", "flag", "label", "a", "b", "total"]
    item = lambda x: F.coalesce(x["flag"] == "DP", F.lit(False))
    total = lambda x: F.coalesce((x["flag"] == "CP") & F.lower(F.trim(x["label"])).startswith("total") & x["a"].isNotNull() & x["b"].isNotNull(), F.lit(False))
    of_items = lambda c: F.coalesce(F.sum(F.when(F.col("flag") == "DP", F.col(c))), F.lit(0))
    gathered = F.sort_array(F.collect_list(F.struct(*kept[2:], F.lit(False).alias("moved")))).alias("rows")
    zero = F.coalesce(F.bool_or((F.col("flag") == "DP") & (F.col("total") == 0)), F.lit(False)).alias("zero")
    of = rows.groupBy("table_id", "section").agg(gathered, of_items("a").alias("off_a"), of_items("b").alias("off_b"), zero)

    def held(rows: Column, c: str) -> Column:
        return F.aggregate(rows, F.lit(0).cast("decimal(38,4)"), lambda s, x: (s + F.when(item(x), F.coalesce(x[c], F.lit(0))).otherwise(0)).cast("decimal(38,4)"))

    def lone(x: Column, here: str, there: str, over: Column) -> Column:
        return item(x) & x[there].isNull() & F.coalesce((x[here] == x["total"]) & (x[here] == over), F.lit(False))

    def other(x: Column) -> Column:
        """The row with its addends changed over."""
        return F.struct(*[x[{"a": "b", "b": "a"}.get(c, c)].alias(c) for c in kept[2:]], F.lit(True).alias("moved"))

    def repaired(rows: Column, anchor: Column) -> Column:
        over_a, over_b = held(rows, "a") - anchor["a"], held(rows, "b") - anchor["b"]
        fits = F.transform(rows, lambda x: lone(x, "a", "b", over_a) | lone(x, "b", "a", over_b))
        at = F.when(over_a == -over_b, F.array_position(fits, True))
        return F.when(at > 0, F.transform(rows, lambda x, i: F.when(i == at - 1, other(x)).otherwise(x))).otherwise(rows)

    # Before the first move all totals see the sums of the input, so sections without a total that an item could mend need no walk.
    could = F.exists("rows", lambda x: total(x) & (F.col("off_a") - x["a"] == x["b"] - F.col("off_b")) & ((F.col("off_a") != x["a"]) | F.col("zero")))
    out = F.when(could, F.aggregate(F.filter("rows", total), F.col("rows"), repaired)).otherwise(F.col("rows"))
    return of.select("table_id", "section", F.explode(out).alias("x")).select("table_id", "section", "x.*")
