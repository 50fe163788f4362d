import random
import re

from ledgerframe.llm import pii

from .conftest import rows_of


def brute(text):
    out = [("email", m.start(), m.end())
           for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    parts = ["a", "Z", "@", ".", ".", "-", "_", "+", "1", "23", "255", "256", "007", " ", "(", ")", "%",
             "4111111111111111", "é", "\n", "0"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert [s[:3] for s in pii.proposals(t) if s[0] in pii.BASE] == brute(t), t


def test_long_runs_are_read_once():
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "AB12 " * 50_000,
              "+1" + "-" * 300_000):
        assert all(s["end"] <= len(t) for s in pii.spans(t))


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    found = pii.spans("My IBAN is GB82 WEST 1234 5698 7654 32, ssn 123-45-6789.")
    assert [(s["kind"], s["score"]) for s in found if s["kind"] in pii.ADDED] == [("iban", 1.0), ("ssn", 0.6)]
    assert [s["kind"] for s in pii.spans("part 123-45-6789 of the list")] == []
    plain, near = pii.spans("x 4111 1111 1111 1111"), pii.spans("card 4111 1111 1111 1111")
    assert plain[0]["score"] < near[0]["score"]


def test_report_over_edge_rows(spark, edge_docs, no_docs):
    docs = edge_docs.unionByName(spark.createDataFrame(
        [(500, "é a@b.co, 10.0.0.1; +49 30 1234567", "s", "x", 1, 2, 3, 4)], edge_docs.schema))
    got = {r["doc_id"]: r for r in rows_of(pii.pii_report(docs))}
    r = got[500]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 0, 1)
    assert r["spans"] == "email:2:8,ip:10:18,phone:20:34"
    assert got[4]["spans"] == got[5]["spans"] == ""
    assert len(rows_of(pii.find_pii(docs))) == docs.count()
    assert pii.pii_report(no_docs).count() == 0


def test_words_behind_an_iban_are_not_part_of_it():
    ibans = ["ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034",
             "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "AT611904300234573201"]
    for iban in ibans:
        for tail in (" BIC CAIXESBB", " CODE", " BANK OF 1234 ABCD", ".", "", " " + ibans[0], ", DE12 3456 7890 1234"):
            got = [(s["start"], s["end"]) for s in pii.spans("IBAN " + iban + tail) if s["kind"] == "iban"]
            assert got[0] == (5, 5 + len(iban)), iban + tail
            assert len(got) == 1 + tail.endswith(ibans[0])
    head = "bank REFS AB12 CDEF GHIJ "
    assert [s["start"] for s in pii.spans(head + ibans[1]) if s["kind"] == "iban"] == [len(head)]
    assert not [s for s in pii.spans("IBAN ES91 2100 0418 4502 0005 1333 BIC") if s["kind"] == "iban"]
