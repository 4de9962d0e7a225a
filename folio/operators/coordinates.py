"""Where on its page a statement's amount stands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: points across a page.
WIDTH = 612.0


def attach(cells: DataFrame, words: DataFrame) -> DataFrame:
    """Gives each cell (doc_id, cell_id, col_index, n_cols, value) the nearest unused word (doc_id, page, word_id, text, x0) of its digits.

    Cells take their words in the order of cell_id, the word whose x0 is nearest to the middle of the cell's column, ties
    by page and word_id; a word is taken once. Cells only compete for words with equal digits, so a group is one number
    of one document, not a document. cell_id is unique in a document, word_id on a page. Cells without digits or words have null page and word_id.
    """
    digits = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "[^0-9]", "")
    left = cells.select("doc_id", digits("value").alias("digits"), "cell_id", (F.lit(WIDTH) * (F.col("col_index") + 0.5) / F.col("n_cols")).alias("at"))
    right = words.select("doc_id", digits("text").alias("digits"), "page", "word_id", F.col("x0").cast("double").alias("x0")).where("digits <> ''")

    own = left.where("digits <> ''").groupBy("doc_id", "digits").agg(F.array_sort(F.collect_list(F.struct("cell_id", "at"))).alias("cells"))
    there = right.groupBy("doc_id", "digits").agg(F.collect_list(F.struct("page", "word_id", "x0")).alias("free"))
    types = dict(left.dtypes) | dict(right.dtypes)
    nothing = F.expr(f"cast(array() as array<struct<cell_id:{types['cell_id']},page:{types['page']},word_id:{types['word_id']}>>)")

    def take(state, cell):
        best = F.array_min(F.transform(state["free"], lambda w: F.struct(F.abs(w["x0"] - cell["at"]).alias("far"), w["page"].alias("page"), w["word_id"].alias("word_id"))))
        left_over = F.filter(state["free"], lambda w: (w["page"] != best["page"]) | (w["word_id"] != best["word_id"]))
        taken = F.concat(state["taken"], F.array(F.struct(cell["cell_id"].alias("cell_id"), best["page"].alias("page"), best["word_id"].alias("word_id"))))
        return F.when(F.size(state["free"]) > 0, F.struct(left_over.alias("free"), taken.alias("taken"))).otherwise(state)

    start = F.struct(F.col("free").alias("free"), nothing.alias("taken"))
    found = own.join(there, ["doc_id", "digits"]).select("doc_id", F.explode(F.aggregate("cells", start, take, lambda s: s["taken"])).alias("x")).select("doc_id", "x.*")
    return cells.join(found, ["doc_id", "cell_id"], "left")
