from __future__ import annotations

import re

from postloom.llm import pii
from postloom.llm.queries import QUERIES
from pyspark.sql import functions as F

KEY = "test key"


def replaced(spark, texts, key=KEY):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, n_entities string")
    return [r for r in sorted(pii.replace_entities(docs, key).collect(), key=lambda r: r.doc_id)]


def luhn(digits):
    own = [int(c) for c in digits][::-1]
    return sum(own[::2]) + sum(d * 2 - 9 * (d > 4) for d in own[1::2])


def test_formats_and_coreference(spark):
    texts = [
        "Mail Ann.Lee7@Mail3.example.com or ann.lee7@mail3.example.com, ANN.LEE7@MAIL3.EXAMPLE.COM.",
        "Call +1 (017) 555-7713 or +1 017 555 7713; from 97.51.17.173.",
        "Card 4111111111111111, 4111 1111 1111 1111 and 4111111111111112 end.",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" x, password: "hunter22!"',
        "IBAN DE89 3704 0044 0532 0130 00 and 123-45-6789",
        "Mrs. Anna Smith met Mr. Smith and Dr. Carl Jones. Mr. Carl Jones left.",
        "госпожа Анна Петрова и господин Петров",
        "nothing here 12 3.5 1.2.3 a@b",
        None,
        "",
    ]
    rows = replaced(spark, texts)
    out = [r.text for r in rows]
    mails = re.findall(r"[\w.]+@[\w.]+\w", out[0])
    assert len(mails) == 3 and mails[0] == mails[1] and mails[2] == mails[0].upper() and re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@[a-z]{4}\d\.[a-z]{7}\.com", mails[0])
    phones = re.findall(r"\+1 [^;o]*\d", out[1])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phones[0]) and re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1])
    assert "017" not in phones[0] or "7713" not in phones[0]
    assert re.search(r"from \d+\.\d+\.\d+\.\d+\.$", out[1]) and "97.51.17.173" not in out[1]
    cards = re.findall(r"\d[\d ]{13,}\d", out[2])
    assert re.fullmatch(r"Card 4\d{15}, 4\d{3} \d{4} \d{4} \d{4} and 4\d{15} end\.", out[2])
    assert re.sub(" ", "", cards[1]) == cards[0] != cards[2] and luhn(cards[0]) % 10 == 0 != luhn(cards[2]) % 10
    assert re.fullmatch(r'token = "[0-9a-f]{40}" x, password: "[a-z]{6}\d\d!"', out[3]) and "hunter" not in out[3]
    assert re.fullmatch(r"IBAN DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d and \d{3}-\d{2}-\d{4}", out[4])
    m = re.fullmatch(r"Mrs\. (\w+a) (\w+) met Mr\. (\w+) and Dr\. (\w+) (\w+)\. Mr\. (\w+o) (\w+) left\.", out[5])
    assert m and m[2] == m[3] and m[5] == m[7] != m[2] and not {"Anna", "Smith", "Carl", "Jones"} & set(m.groups())
    m = re.fullmatch(r"госпожа ([А-Я]\w+а) ([А-Я]\w+ов)а и господин ([А-Я]\w+ов)", out[6])
    assert m and m[2] == m[3] != "Петров"
    assert out[7:] == texts[7:]
    assert [r.n_entities for r in rows] == [3, 3, 3, 2, 2, 4, 2, 0, 0, 0]
    assert rows[1].entity_kinds == ["ip", "phone"] and rows[5].entity_kinds == ["person"] and rows[9].entity_kinds == []


def test_keyed_and_repeatable(spark):
    texts = ["x@example.org, 10.20.30.40"] * 3
    first = [r.text for r in replaced(spark, texts)]
    assert len(set(first)) == 1 and first == [r.text for r in replaced(spark, texts)]
    assert first != [r.text for r in replaced(spark, texts, key="another")]


def test_clashes_are_settled(spark):
    """Few formats and many entities: two-letter addresses must clash, and stay distinct all the same."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.io" for a in letters for b in letters][:500]
    rows = replaced(spark, [" ".join(mails[:300]), " ".join(mails[200:]), "one " + mails[5]])
    seen = {}
    for row, own in zip(rows, (mails[:300], mails[200:], ["one", mails[5]]), strict=True):
        for old, new in zip(own, row.text.split(" "), strict=True):
            assert seen.setdefault(old, new) == new
    del seen["one"]
    assert len(set(seen.values())) == 500 and not set(seen.values()) & set(mails)


def test_native_plan_and_whole_table(spark, sf_dir):
    df = QUERIES["op3_pii"](spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(before)
    mail = re.compile(r"[\w.%+-]+@[\w.-]+\.[a-z]{2,}|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}|\b[0-9a-f]{40}\b")
    for r in rows:
        old, new = mail.findall(before[r.doc_id]), mail.findall(r.text)
        assert len(old) == len(new) and not set(old) & set(new)
        assert (r.text == before[r.doc_id]) == (r.n_entities == 0) and len(re.sub("[0-9a-z.]+", "", r.text)) <= len(before[r.doc_id])
    assert any(r.n_entities for r in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.replace_entities(docs, KEY).collect() == []
    assert pii.replace_entities(spark.createDataFrame([(1, None)], "doc_id long, text string"), KEY).select(F.col("text")).collect()[0].text is None


def test_secrets_of_any_length(spark):
    for n in (128, 129, 4096):
        hexes, quoted = ("0123456789abcdef" * n)[:n], ("aZ9-_x.Q" * n)[:n]
        texts = [f"key {hexes} end", f"key {hexes.upper()} end", f'token: "{quoted}" end', f'token: "{hexes}" end']
        rows = replaced(spark, texts)
        assert [r.n_entities for r in rows] == [1] * 4 and all(r.entity_kinds == ["secret"] for r in rows)
        for row, old in zip(rows, texts, strict=True):
            assert len(row.text) == len(old) and row.text != old and hexes[:32] not in row.text.lower() and quoted[:32] not in row.text
        assert re.fullmatch(r"key [0-9a-f]+ end", rows[0].text) and re.fullmatch(r"key [0-9A-F]+ end", rows[1].text)
