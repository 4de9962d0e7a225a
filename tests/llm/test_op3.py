import re

import regex

from folio.llm.op3_license_scan import ANCHORS, KNOWN, RULES, SENTENCES, op3_license_scan, scan

from .helpers import SF, table


def plain(text):
    lower = (text or "").lower()
    parts = re.sub(r"[.!?;]+(\s)", r"\n\1", lower, flags=re.ASCII).split("\n")
    normal = [regex.sub(r"[^\p{L}\p{N}]+", " ", re.sub(r"[.!?;]+$", "", p)).strip(" ") for p in parts]
    ids = [KNOWN[s] for s in normal if s in KNOWN]

    def holds(rule):
        rest = iter(ids)
        return all(i in rest for i in rule)

    names = {name for name, rule in RULES if holds(rule)}
    return ids, sorted(names - {"Proprietary"} if len(names) > 1 else names)


def test_equals_plain_on_the_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op3_license_scan(spark, SF).collect()
    assert len(got) == len(texts) and any(r.licenses for r in got)
    for r in got:
        ids, names = plain(texts[r.doc_id])
        assert (r.n_sentences, r.sentences, r.licenses) == (len(ids), ",".join(ids), ",".join(names))


def test_each_rule_in_order_and_out_of_order(spark):
    rows = []
    for k, (_, ids) in enumerate(RULES):
        own = [SENTENCES[i] for i in ids]
        rows += [(10 * k, ". ".join(own) + "."), (10 * k + 1, "Some words.\n" + "\nOther words here\n".join(own)), (10 * k + 2, ".\n".join(reversed(own))), (10 * k + 3, "; ".join([*own[:2], "All rights reserved", *own[2:]]) + "!")]
    for r in scan(table(spark, rows)).collect():
        assert (r.sequence, r.licenses) == plain(r.text), r.text
        if r.doc_id % 10 != 2 or len(RULES[r.doc_id // 10][1]) == 1:
            assert RULES[r.doc_id // 10][0] in r.licenses, r.text


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, "copyright " * 50_000), (4, "LICENSED  under the\tMIT License!?"), (4, "LICENSED  under the\tMIT License!?"), (None, "All rights reserved"), (6, "not all rights reserved"), (7, "é. All Rights Reserved.\r\nend")]
    got = [(r.doc_id, r.n_sentences, r.licenses) for r in scan(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, []), (2, 0, []), (3, 0, []), (4, 1, ["MIT"]), (4, 1, ["MIT"]), (None, 1, ["Proprietary"]), (6, 0, []), (7, 1, ["Proprietary"])], key=str)
    assert scan(table(spark, [])).count() == 0
    more = table(spark, [(1, "x", "y", 3)], "doc_id int, text string, sequence string, n_sentences int")
    assert [(r.sequence, r.n_sentences, r.licenses) for r in scan(more).collect()] == [([], 0, [])]
    assert all(any(a in s for a in ANCHORS) for s in KNOWN)
