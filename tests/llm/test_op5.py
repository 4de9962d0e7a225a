import random
from collections import defaultdict

import pytest
import regex

from folio.llm.op5_decontamination import NAMES, NOUN_AFTER, NUMBERS, UNITS, contaminated

from .helpers import SF, table

ITEM = "item_id long, text string"
WORDS = "carry river stone cloud letter garden window music paper table chair forest"


def tokens(text):
    """(values, template) of a text, token by token."""
    text = regex.sub("[\x02-\x05]", " ", text or "")
    raw = [(m.start(), m[0]) for m in regex.finditer(r"(?:\p{N}[.,](?=\p{N})|[\p{L}\p{M}\p{N}])+", text)]
    out = []
    for i, (at, t) in enumerate(raw):
        before = raw[i - 1][1].lower() if i else ""
        named = regex.match(r"\p{Lu}\p{Ll}", t) and regex.search(r"[\p{Ll},;] $", text[:at]) and before not in NOUN_AFTER
        low = t.lower()
        kind = "name" if named else "num" if regex.match(r"\p{N}", t) or low in NUMBERS else "name" if low in NAMES else "unit" if low in UNITS else None
        if out and kind in ("num", "name") and out[-1][1] == kind:
            out[-1] = (out[-1][0] + "_" + low, kind)
        else:
            out.append((low, kind))
    return out


def plain(docs, items, width=8, literals=3, share=50):
    wanted = {}
    for item, text in items:
        t = tokens(text)
        if item is not None and t:
            n = len(t)
            w = min(width, n // 2) if 10 <= n <= 2 * width else min(width, n)
            wanted[item, tuple(t)] = (w, [(at, t[at : at + w]) for at in range(n - w + 1)])
    form = lambda w: tuple(f"<{k}>" if k else v for v, k in w) if sum(k is None for _, k in w) >= min(literals, len(w)) else tuple(w)
    best = {}
    for doc, text in docs:
        t = tokens(text)
        for (item, own), (w, cuts) in wanted.items() if doc is not None else ():
            there, n = defaultdict(list), len(own)
            for start in range(len(t) - w + 1):
                there[form(t[start : start + w])].append(start)
            by = defaultdict(list)
            for at, cut in cuts:
                for start in there.get(form(cut), ()):
                    by[start - at].append((at, start, [(b, t[start + i]) for i, b in enumerate(cut) if b[1]]))
            groups, last = [[x] for x in by.values()], None
            for d in sorted(by):
                if last is None or d - last > max(1, n // 4):
                    groups.append([])
                groups[-1].append(by[d])
                last = d
            for group in groups:
                hits = [h for part in group for h in part]
                slots = {s for _, _, own_slots in hits for s in own_slots}
                count = min(len({h[side] + i for h in hits for i in range(w)}) for side in (0, 1)) if hits else 0
                if hits and len({b for b, _ in slots}) == len(slots) and 100 * count >= share * n:
                    row = (count, all(b == d for b, d in slots), len(slots), n)
                    best[doc, item] = max(best.get((doc, item), row), row)
    return sorted((d, i, c, n, s, v) for (d, i), (c, v, s, n) in best.items())


def result(df):
    return sorted((r.doc_id, r.item_id, r.n_covered, r.n_tokens, r.n_slots, r.verbatim) for r in df.collect())


def found(spark, docs, items):
    return {(r.doc_id, r.item_id) for r in contaminated(table(spark, docs), table(spark, items, ITEM)).collect()}


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_equals_plain_on_the_documents(spark, monkeypatch, broadcast):
    import folio.llm.op5_decontamination as m

    monkeypatch.setattr(m, "BROADCAST_ROWS", broadcast)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    want = plain([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert result(contaminated(docs, items)) == want and want


QUESTION = "Alice bought 12 apples for 30 dollars and gave 5 of the apples to her friend Bob before walking 3 miles back home with the rest"
OTHERS = QUESTION.replace("Alice", "Emma").replace("12", "47").replace("30", "99").replace("5 of", "8 of").replace("Bob", "Henry").replace("3 miles", "6 km").replace("dollars", "euros")


def test_parameters_changed_throughout(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choice("river stone cloud letter garden window music paper") for _ in range(n))
    docs = [(1, f"{filler(40)} {QUESTION} {filler(9)}"), (2, f"{filler(5)} {OTHERS}. {filler(60)}"), (3, OTHERS.replace("99", "47")), (4, filler(300)), (5, QUESTION[:40]), (6, OTHERS * 2)]
    docs += [(7, OTHERS.replace("gave 8", "gave 1,250")), (8, OTHERS.replace("99", "2.5")), (9, OTHERS.replace("Henry", "Mary Ann")), (10, "She walked home with the rest of the apples")]
    items = [(7, QUESTION), (7, QUESTION), (8, filler(12))]
    got = result(contaminated(table(spark, docs), table(spark, items, ITEM)))
    assert got == plain(docs, items)
    assert {(d, v) for d, i, _, _, _, v in got if i == 7} == {(1, True), (2, False), (3, False), (6, False), (7, False), (8, False), (9, False)}


def test_one_value_for_two_is_inconsistent(spark):
    item = "take 7 red stones and add 7 blue stones then give 7 green stones away and count all 7 again"
    torn = "take 5 red stones and add 6 blue stones then give 8 green stones away and count all 9 again"
    assert found(spark, [(1, torn), (2, torn.replace("6", "5").replace("8", "5").replace("9", "5"))], [(1, item)]) == {(2, 1)}


def test_few_literals_separators_and_german_nouns(spark):
    items = [(1, "12 kg is 30 lb"), (2, "What is 12 plus 30 minus 7"), (3, "Der Lehrer gab dem Schüler den Ball und das Buch"), (4, "12 Bob 14 Emma 15")]
    docs = [(1, "12 kg is 30 lb"), (2, "What is 3.5 plus 31 minus 8"), (3, "Der Hund gab dem Nachbar den Knochen und das Heft"), (4, "and 13 kg is 30 lb too"), (5, "we say 12 kg is 30 lb too"), (6, "sum 12 Bob 14 Emma 15 on"), (7, "sum 12 Bob 14 Emma 16 on"), (8, "Und der Lehrer gab dem Schüler den Ball und das Buch")]
    assert found(spark, docs, items) == {(1, 1), (5, 1), (2, 2), (6, 4), (8, 3)}


def test_one_edit_anywhere_is_found(spark):
    rng = random.Random(5)
    items, docs = [], []
    for n in (10, 13, 16, 20, 40):
        own = [f"{rng.choice(WORDS.split())}{chr(97 + i % 26)}{chr(97 + n % 26)}" for i in range(n)]
        items.append((n, " ".join(own)))
        for k in range(n):
            docs += [(1000 * n + k, " ".join([*own[:k], "changed", *own[k + 1 :]])), (1000 * n + 100 + k, " ".join([*own[:k], "added", *own[k:]])), (1000 * n + 200 + k, " ".join(own[:k] + own[k + 1 :]))]
    docs.append((1, " ".join(rng.choice(WORDS.split()) for _ in range(400))))
    assert found(spark, [(d, f"some words before {t} and after") for d, t in docs], items) == {(d, d // 1000) for d, _ in docs if d > 1}


def test_cases(spark):
    docs = [(1, None), (2, ""), (None, QUESTION), (3, QUESTION), (3, QUESTION), (4, "12 " * 50_000), (5, "the long word of it"), (6, "x" * 300_000), (7, "a \x04Gave \x03 12")]
    items = [(1, QUESTION), (2, None), (3, ""), (None, QUESTION), (4, "12 13 14"), (5, "the long word of it")]
    assert sorted(found(spark, docs, items)) == [(3, 1), (5, 5)]
    assert found(spark, [], items) == found(spark, docs, []) == set()
    more = table(spark, [(3, QUESTION, 1, "x", "y")], "doc_id int, text string, item_id int, anchor string, form string")
    other = table(spark, [(1, QUESTION, "z")], "item_id int, text string, anchor string")
    assert [r.item_id for r in contaminated(more, other).collect()] == [1]
