import random
import re

from pyspark.sql import functions as F

from helpers import awkward, nothing
from txnsieve.llm import pii


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text: str) -> list[str]:
    """The base spans by the plain patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return [":".join(map(str, s)) for s in out]


def spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find_pii(docs)
    rows = found.select(
        "doc_id", pii.span_text(F.col("pii_spans")).alias("all"), pii.span_text(pii.base_spans(F.col("pii_spans"))).alias("base")
    )
    return {r["doc_id"]: r for r in rows.collect()}


def test_base_spans_equal_the_plain_patterns(spark):
    random.seed(5)
    parts = [
        "a@b.c", "x.y+z@mail-1.example.com", "@", ".", "a@b", "a@b.c_d@e.f", "1.2.3.4", "256.1.1.1", "001.002.003.004", "1.2.3.4.5.6.7.8.9",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "4111111111111111000", "1 ", "-", "+1 (555) 010-9999", "+123",
        "+4912345678901234567", "é", "日", " ", "\n", "12", "99999999999999999999999", "+1.2.3.4", "++12 34 56 78", "a@b.c@d.e",
    ]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(1500)]
    texts += ["a" * 30_000 + "@x.y", "1" * 30_000, "1." * 20_000, "a@" + "b." * 20_000 + "c", "+1" + " " * 20_000]
    got = spans(spark, texts)
    for i, text in enumerate(texts):
        assert got[i]["base"] == ",".join(base(text)), text[:200]


def test_added_kinds_need_checksum_or_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 ok", "DE88 3704 0044 0532 0130 00", "amex 378282246310005", "378282246310005",
        "SSN 123-45-6789", "123-45-6789", "call (555) 010-9999 now", "code 555-010-9999", "GB82WEST12345698765432",
    ]
    kinds = {i: re.findall("[a-z_]+", r["all"]) for i, r in spans(spark, texts).items()}
    assert kinds == {
        0: ["iban"], 1: [], 2: ["short_card"], 3: [], 4: ["ssn"], 5: [], 6: ["local_phone"], 7: [], 8: ["iban"],
    }


def test_masking_and_awkward_rows(spark):
    docs = awkward(spark, ["write a@b.c or +1 (555) 010-9999!", "card 4111 1111 1111 1111."])
    out = pii.mask_pii(docs, length_col="n_chars")
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[100]["text"] == "write [EMAIL] or [PHONE]!" and rows[100]["n_chars"] == 25
    assert rows[101]["text"] == "card [CARD]."
    assert rows[2]["text"] is None and rows[2]["n_chars"] is None and rows[3]["text"] == ""
    assert rows[5]["n_chars"] == docs.where("doc_id = 5").first()["n_chars"]
    assert pii.mask_pii(nothing(spark)).count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_context_stands_on_either_side(spark):
    far = " " * pii.CONTEXT_CHARS
    texts = [
        "123-45-6789 is my SSN", "555-010-9999 (phone)", "378282246310005 on my Amex", "ssn 123-45-6789", "phone 555-010-9999",
        f"123-45-6789{far[3:]}ssn", f"123-45-6789{far[2:]}ssn", f"ssn{far[3:]}123-45-6789", f"ssn{far[2:]}123-45-6789",
        "s123-45-6789sn", "123-45-6789, 555-010-9999 is the fax",
    ]
    kinds = {i: re.findall("[a-z_]+", r["all"]) for i, r in spans(spark, texts).items()}
    assert kinds == {
        0: ["ssn"], 1: ["local_phone"], 2: ["short_card"], 3: ["ssn"], 4: ["local_phone"], 5: ["ssn"], 6: [], 7: ["ssn"], 8: [],
        9: [], 10: ["local_phone"],
    }
    docs = spark.createDataFrame([(0, texts[0]), (1, texts[1])], "doc_id long, text string")
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(docs).collect()}
    assert masked == {0: "[SSN] is my SSN", 1: "[LOCAL_PHONE] (phone)"}
