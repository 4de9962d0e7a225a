"""The total check of statements against a plain one, total by total, on random statements of every type."""

import random
from decimal import Decimal as D

import pytest

from folio.operators.rule_sets import RULES
from folio.operators.statement_check import check_lines, check_statements
from folio.plans.statements import statement_check_soa

ROWS = "doc_id int, stmt_type string, table_id string, section string, row_order int, flag string, label string, datapoint string, col string, col_pos int, amt decimal(38,4)"
COLS = ["Total", "City", "Component Units", "Premium/Discount", "Total Debt Service"]


def low(x):
    return (x or "").strip().lower()


class Plain:
    """One statement: rows (table, section, order, flag, label, name, {col: amount})."""

    def __init__(self, kind, rows, cols):
        self.rows, self.cols = rows, cols
        sections = {low(r[1]) for r in rows}
        if kind == "PROP_SNP" and "net assets" in sections and "net position" not in sections and not any("deferred outflows" in s or "deferred inflows" in s for s in sections):
            kind = "PROP_SNP_NONPROFIT"
        self.kind = kind

    def of(self, table, flag, section=None):
        return [r for r in self.rows if r[0] == table and r[3] == flag and (section is None or low(r[1]) == low(section))]

    def add(self, rows):
        return {c: sum((r[6][c] or D(0) for r in rows), D(0)) for c in self.cols}

    def source(self, s, table):
        if s.kind in ("total", "exact"):
            own = [r for r in self.of(table, "CP") if low(r[5]) == low(s.name)]
            near = [r for r in self.of(table, "CP") if low(r[5]) in low(s.name) and len(low(r[5])) < len(low(s.name))]
            pick = own[-1:] or (near[:1] if s.kind == "total" else [])
            return self.add(pick) if pick else None
        rows = [r for r in self.of(table, "DP", s.section) if s.kind == "section" or low(r[5]) == low(s.name)]
        rows = rows[:1] if s.kind == "item" else rows
        return self.add(rows) if rows else None

    def candidates(self, rule, total):
        table, _, at, *_ = total
        items, zero = self.of(table, "DP", rule.section), {c: D(0) for c in self.cols}
        if rule.kind == "chains":
            for chain in rule.chains:
                values = [(m, next((v for v in (self.source(s, table) for s in m.sources) if v is not None), None)) for m in chain]
                yield all(v is not None or not m.required for m, v in values), {c: sum((m.sign * (v or zero)[c] for m, v in values), D(0)) for c in self.cols}
            return
        before = [r for r in self.of(table, "CP", rule.section) if r[2] < at]
        window = [r for r in items if (before[-1][2] if before else -1) < r[2] < at]
        hit = lambda r: not rule.contains or any(c in low(r[4]) for c in rule.contains)
        out = lambda r: any(e in low(r[4]) for e in rule.excludes)
        kept = lambda rows: [r for r in rows if hit(r) and not out(r)]
        if rule.kind == "section":
            yield True, self.add([r for r in items if not out(r)])
            yield True, self.add(items)
        elif rule.kind == "labels":
            yield True, self.add(kept(items))
        elif rule.kind == "labels_not_start":
            yield True, self.add([r for r in items if hit(r) and not any(low(r[4]).startswith(e) for e in rule.excludes)])
        elif rule.kind == "labels_since_total":
            yield True, self.add(kept(window))
        elif rule.kind == "labels_positional":
            yield bool(kept(window)) or not window, self.add(kept(window))
            yield True, self.add(window)
        elif rule.kind == "rolling":
            yield True, self.add(window)
            yield bool(before), self.add(window + before[-1:])
        elif rule.kind == "names":
            yield True, self.add([r for r in items if low(r[5]) in rule.contains])
        elif rule.kind == "current_liabilities":
            prefixed = [r for r in items if low(r[4]).startswith("current liabilities:")]
            yield True, self.add(prefixed or [r for r in items if not low(r[5]).endswith("- noncurrent")])
            blank = [r for r in before if not low(r[5])]
            yield bool(blank), self.add(blank)
        elif rule.kind == "blank":
            yield True, self.add(items)
        else:
            sums = self.add(self.of(table, "DP", total[1]))
            for c in self.cols:
                if low(c) == "premium/discount":
                    sums[c] = total[6][c] or D(0)
                elif low(c) == "total debt service":
                    sums[c] += sum((total[6][p] or D(0) for p in self.cols if low(p) == "premium/discount"), D(0))
            yield True, sums

    def applies(self, rule, total):
        if rule.kind == "schedule":
            return total == self.of(total[0], "CP", total[1])[0]
        return low(rule.name) == low(total[5]) and (rule.kind != "blank" or low(rule.section) == low(total[1]))

    def status(self, total):
        status = None
        for rule in RULES.get(self.kind, []):
            if not self.applies(rule, total) or rule.when == "open" and status not in (None, "skip") or rule.when == "not passed" and status == []:
                continue
            fails = lambda v: [c for c in self.cols if abs(v[c] - (total[6][c] or D(0))) > 1]
            usable = [fails(v) for ok, v in self.candidates(rule, total) if ok]
            if not usable:
                status = status if rule.when != "always" else "skip"
            elif rule.pick == "more":
                status = min(usable, key=len)
            else:
                status = next((f for f in usable if not f), usable[0]) if rule.pick == "match" else usable[0]
        if self.kind == "SOA" and isinstance(status, list) and {"Total", "Component Units"} <= set(self.cols):
            between = self.cols[self.cols.index("Total") + 1 : self.cols.index("Component Units")]
            status = [c for c in status if not any(b in f"{c}: FAIL" for b in between)]
        return {None: "Skipped - no rule defined", "skip": "Skipped - no chain matched"}.get(status) if not isinstance(status, list) else " | ".join(f"{c}: FAIL" for c in status) or "PASS"


def statements(kind, seed, n=12):
    rng = random.Random(f"{kind}{seed}")
    own = RULES["PROP_SNP_NONPROFIT" if kind == "PROP_SNP" and seed else kind]
    sections = list(dict.fromkeys([r.section for r in own if r.section] + [s.section for r in own for c in r.chains for m in c for s in m.sources if s.section])) or ["Schedule"]
    names = [r.name for r in own if r.name != "*"] + [s.name for r in own for c in r.chains for m in c for s in m.sources if s.kind == "total"] + ["", "Total"]
    labels = [c for r in own for c in r.contains + r.excludes] + ["Cash", "current liabilities: x"]
    items = [c for r in own for c in r.contains] + [s.name for r in own for c in r.chains for m in c for s in m.sources if s.kind in ("item", "items")] + ["Cash", "Loans - noncurrent"]
    for doc in range(n):
        cols = rng.choice([COLS[:1], COLS[:3], COLS[:2], COLS[3:], COLS])
        rows, at = [], 0
        for section in rng.sample(sections, rng.randint(1, len(sections))):
            for _ in range(rng.randint(1, 7)):
                flag = rng.choice(["DP", "DP", "DP", "CP", "DPG"])
                amount = {c: rng.choice([None, D(rng.randint(0, 3)), D(rng.randint(-2, 5))]) for c in cols}
                rows.append((rng.choice("AAB"), rng.choice([section, section.upper()]), at, flag, rng.choice(labels), rng.choice(names) if flag == "CP" else rng.choice(items), amount))
                at += 1
        yield doc, cols, rows


@pytest.mark.parametrize("kind", [k for k in RULES if k != "PROP_SNP_NONPROFIT"] + ["PEN", "XYZ"])
def test_equals_plain(spark, kind):
    if kind not in RULES:
        df = spark.createDataFrame([(1, kind, "A", "s", 0, "CP", "x", "Total", "c", 0, D(1))], ROWS)
        assert check_statements(df).first().status == (None if kind == "PEN" else "Skipped - no rule defined")
        return
    rows, want = [], {}
    for seed in range(2):
        for doc, cols, own in statements(kind, seed, 40):
            doc += 1000 * seed
            plain = Plain(kind, own, cols)
            want |= {(doc, r[2]): plain.status(r) for r in own if r[3] == "CP"}
            rows += [(doc, kind, *r[:6], c, k, r[6][c]) for r in own for k, c in enumerate(cols)]
    got = {(r.doc_id, r.row_order): r.status for r in check_statements(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == want
    assert {"PASS"} < set(want.values())


LINES = ROWS.replace("col string, col_pos int, amt decimal(38,4)", "cols array<string>, col_pos array<int>, amts array<decimal(38,4)>")


def test_lines_of_all_columns_equal_rows_of_one(spark):
    """Also where lines lack columns, columns share a name or a place, and lines share a place."""
    rng, rows, lines = random.Random(11), [], []
    for n, kind in enumerate(k for k in RULES if k != "PROP_SNP_NONPROFIT"):
        for doc, cols, own in statements(kind, n % 2, 25):
            ragged, ties = rng.random() < 0.3, rng.random() < 0.3
            names, places = rng.choice([cols, cols, ["Total", *cols[1:-1], "Total"]])[: len(cols)], rng.choice([list(range(len(cols))), [rng.randrange(3) for _ in cols]])
            for table, section, at, *rest, amounts in own:
                have = [k for k in range(len(cols)) if not ragged or rng.random() < 0.7]
                row = (1000 * n + doc, kind, table, section, at // 2 if ties else at, *rest)
                cells = [(names[k], places[k], amounts[cols[k]]) for k in have]
                rows += [(*row, *c) for c in cells]
                lines.append((*row, *([c[i] for c in cells] for i in range(3))))
    key = lambda df: sorted(map(str, df.collect()))
    got = key(check_lines(spark.createDataFrame(lines, LINES)))
    assert got == key(check_statements(spark.createDataFrame(rows, ROWS))) and len(got) > 300


def test_columns_are_no_rows(spark):
    """A line of four columns is gathered once."""
    told = statement_check_soa(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in told and told.count("Generate explode") == 2
