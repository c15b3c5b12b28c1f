import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from panelwright.llm import infill
from tests.llm import awkward


def by_hand(doc_id, text, seed=1, plain=10, spm=20):
    """The result for one row, from the definition."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_equals_the_definition(spark):
    docs = awkward.documents(spark)
    odd = ["<P>", "a<S>b", "<P", "P>x<", "<<S", "<S<M", "a\nb\r\nc d", "😀a😀", "$1\\2 ${x}", "()[]{}+*?^|", "\x00a\x00", "ſKé", "zz" * 9]
    more = spark.createDataFrame([(100 + i, t * (1 + i % 3)) for i, t in enumerate(odd * 12)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(more)
    want = Counter(by_hand(*r) for r in both.collect())
    assert rows_of(infill.transform(both)) == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}
    assert rows_of(infill.transform(docs)) == Counter(by_hand(r["doc_id"], r["text"]) for r in docs.collect())
    other = Counter(by_hand(*r, 7, 0, 100) for r in both.collect())
    assert rows_of(infill.transform(both, seed=7, plain_percent=0, spm_percent=100)) == other


def test_every_output_gives_its_text_back(spark):
    docs = awkward.documents(spark)
    made = infill.transform(docs).select("id", infill.restored(F.col("output"), F.col("form")))
    assert rows_of(made) == Counter((r["doc_id"], r["text"] or "") for r in docs.collect())


def test_texts_of_very_many_units(spark):
    """Two million units need neither stack nor a second try of the pattern."""
    docs = spark.createDataFrame([(i, (f"ab{i} é😀\n" * 330_000)) for i in range(3)], "doc_id long, text string")
    assert rows_of(infill.transform(docs, plain_percent=0)) == Counter(by_hand(r[0], r[1], plain=0) for r in docs.collect())


def test_no_rows(spark):
    assert infill.transform(awkward.nothing(spark)).isEmpty()


def test_plan_has_one_pass(spark):
    plan = infill.transform(awkward.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
