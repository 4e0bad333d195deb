import re
from collections import Counter

import pytest

from kestrel.llm import linerules

WORD = re.compile(linerules.WORD)


def measures(text):
    """Plain Python on one text: the base measures and the base verdict."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def rule(line):
    n = len(WORD.findall(line))
    count = lambda p: len(re.findall(p, line))
    if not n:
        return 0
    if count(linerules.SEPARATORS) * 5 > n or re.search(linerules.MENU, line):
        return 1
    if any(p in line.lower() for p in linerules.BOILERPLATE):
        return 2
    open_end = not re.search(linerules.SENTENCE_END, line) and count(linerules.SENTENCE_MARK) * linerules.PROSE < n
    return 3 if count(linerules.MARK_RUNS) * 5 > n or open_end else 0


def verdict(text):
    lines = (text or "").split("\n")
    lost = sum(len("".join(WORD.findall(x))) for x in lines if rule(x))
    n, chars, *_, failed = measures(text)
    return not failed and 100 * lost <= 40 * chars, lost, "\n".join(x for x in lines if not rule(x))


def prose(words, seed=0):
    return " ".join(f"w{seed}x{k}{'.' if k % 9 == 8 else ''}" for k in range(words)) + "."


TEXTS = [None, "", " \n\t\n", "one", "a b", "a b c", "a b c a b c", "a a a a", prose(60), prose(60) + "\n" + "Home | About | Contact",
         "\n".join(["Home | About | Login"] * 30), prose(70).replace(".", ""), prose(40, 1) + "\n" + prose(40, 2) + "\nAll rights reserved.",
         "\n".join(f"{prose(12, k)}" for k in range(8)) + "\n" + "\n".join(["same line again."] * 2),
         "wow!! " * 60 + "\nend.", "x\ry\x0bz\x1cq " * 20, "été 漢字。 " * 30, "#*$%&|<> " * 60, "Menu\nSearch\n" + prose(55),
         prose(55) + '"', "\n" * 50 + prose(51), ("alpha beta gamma. " * 40), "We use. Click here to go. " + prose(80, 3)]


def test_measures_and_verdict_match_plain_python(docs):
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)]
    found = {r["doc_id"]: r for r in linerules.clean(docs(rows)).collect()}
    assert len(found) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        r = found[k]
        assert tuple(r[c] for c in [*linerules.MEASURES, "base_failed"]) == measures(text), text
        assert (r["kept"], r["lost_chars"], r["clean_text"]) == verdict(text), text
        assert sum(r["failed_lines"]) == sum(rule(x) > 0 for x in (text or "").split("\n"))


def test_whole_documents_match_plain_python(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    found = linerules.clean(table.select("doc_id", "text")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r[c] for c in [*linerules.MEASURES, "base_failed"]) == measures(texts[r["doc_id"]])
        assert (r["kept"], r["lost_chars"], r["clean_text"]) == verdict(texts[r["doc_id"]])


@pytest.mark.parametrize("line,expected", [
    ("Home | Products | Blog", 1), ("Read more", 1), ("Contact us", 1), ("The back of the shop.", 0), ("Terms of Service apply.", 2),
    ("A plain sentence.", 0), ('He said "so."', 0), ("no mark at the end", 3), ("buy!! now!! cheap!! a.", 3), ("  ", 0)])
def test_rules_of_a_line(docs, line, expected):
    row = linerules.clean(docs([(1, line, "s")])).first()
    assert list(row["failed_lines"]) == [int(expected == k + 1) for k in range(3)]


def test_odd_rows_and_clashing_names(odd):
    out = linerules.clean(odd.withColumnsRenamed({"label": "kept", "path": "_words", "block": "_rules", "start": "n_words"}))
    rows = out.collect()
    assert len(rows) == 9 and {"score", "fp", "kept", "n_words"} <= set(out.columns)
    assert all(not r["kept"] for r in rows) and {r["n_words"] for r in rows if r["doc_id"] == 5} == {30_000}


def test_long_text_and_empty_table(docs):
    text = " ".join(f"w{k % 50_000}" for k in range(60_000)) + "."
    row = linerules.clean(docs([(1, text, "s")])).first()
    assert tuple(row[c] for c in [*linerules.MEASURES, "base_failed"]) == measures(text)
    assert linerules.clean(docs([(1, "x", "s")]).limit(0)).count() == 0


def test_labelled_documents(spark):
    """Rows that the table's labels call good stay (base rules aside), rows they call bad go."""
    d = "/root/testdata/sf0.1"
    judged = (linerules.clean(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"))
              .join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("not base_failed").groupBy("quality", "kept").count())
    counts = {(r["quality"], r["kept"]): r["count"] for r in judged.collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[(1, True)]
    assert counts.get((0, True), 0) <= 0.05 * counts[(0, False)]


def test_no_python_and_no_shuffle(docs):
    plan = linerules.clean(docs([(1, "x", "s")]).coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "Generate" not in plan
