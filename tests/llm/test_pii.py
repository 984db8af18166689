import hashlib
import random
import re

from stratum.llm.pii import find_pii, pii_report, redact_pii
from tests.llm.conftest import by_id, numbered

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def brute(text):
    spans, counts = [], []
    for kind, rule in RULES.items():
        own = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(rule, text or "") if valid(kind, m[0])]
        counts.append(len(own))
        spans += own
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest()), spans


def card(rng, n):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + str(x) for x in range(10) if luhn(body + str(x)))


FIXED = [
    None, "", "a@b.c_d@e.f @x.y a@b", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 0.0.0.0 00.001.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1111 x +1 (487) 555-7209.", "4111 1111 1111 1112",
    "1" * 30000 + ".", "a." * 20000 + "@b.c" + ".d" * 20000, "9 " * 30000, "+1" + "2 " * 20000,
    "a@b.cc " * 3000 + "é", "é😀 x@y.zz", "same x@y.zz", "same x@y.zz",
]


def test_base_spans_equal_brute_force(frame):
    rng = random.Random(5)
    pieces = list("0123456789 -.+@ab%_()é😀") + ["user@h.com", "+49 170 1234567", "1.2.3.4", " "]
    texts = FIXED + ["".join(rng.choice(pieces + [card(rng, 16), card(rng, 19)])
                             for _ in range(rng.randrange(1, 40))) for _ in range(800)]
    got = by_id(pii_report(frame(numbered(texts))))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, spans = brute(t)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want
        listed = r.spans.split(",") if r.spans else []
        assert [s for s in listed if s.split(":")[0] in RULES] == spans


def test_added_kinds_need_checksum_or_context(frame):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok", "IBAN GB82 WEST 1234 5698 7654 33 no",
             "my ssn 123-45-6789", "part 123-45-6789", "ssn 000-45-6789",
             "call 555-123-4567", "number 555-123-4567", "amex card 378282246310005", "id 378282246310005"]
    got = by_id(find_pii(frame(numbered(texts))))
    kinds = {i: [(x["kind"], x["value"]) for x in r.findings] for i, r in got.items()}
    assert kinds == {0: [("iban", "GB82 WEST 1234 5698 7654 32")], 1: [],
                     2: [("national_id", "123-45-6789")], 3: [], 4: [],
                     5: [("local_phone", "555-123-4567")], 6: [],
                     7: [("short_card", "378282246310005")], 8: []}
    plain = by_id(find_pii(frame(numbered(["4111111111111111", "visa 4111111111111111"]))))
    assert plain[1].findings[0]["score"] > plain[0].findings[0]["score"] >= 0.6


def test_context_is_the_text_before_not_the_gap_between_matches(frame):
    texts = ["call 555-123-4567 or 555-987-6543", "amex card exp 12/27 no 378282246310005",
             "ssn 123-45-6789, 234-56-7891", "call " + "x" * 36 + " 555-987-6543",
             "tel 555-123-4567 " + "y" * 30 + " 555-987-6543",
             "call" + " 555-123-4567" * 600]
    got = by_id(find_pii(frame(numbered(texts))))
    values = [[x["value"] for x in got[i].findings] for i in range(5)]
    assert values == [["555-123-4567", "555-987-6543"], ["378282246310005"],
                      ["123-45-6789", "234-56-7891"], [], ["555-123-4567"]]
    # Each of the 600 is judged by its own 40 characters, also across blocks of matches.
    seen = [m.start() for m in re.finditer("555-123-4567", texts[5])
            if "call" in texts[5][max(0, m.start() - 40):m.start()]]
    assert [x["start"] for x in got[5].findings] == seen
    assert by_id(redact_pii(frame(numbered(texts))))[0].text == "call <LOCAL_PHONE> or <LOCAL_PHONE>"


def test_context_reaches_over_blocks(frame):
    text = "12 / " * 300 + "card 12 / 34 no 378282246310005"
    assert [x["kind"] for x in by_id(find_pii(frame(numbered([text]))))[0].findings] == ["short_card"]


def iban(code, body):
    number = "".join(str(int(c, 36)) for c in body + code + "00")
    return f"{code}{98 - int(number) % 97:02d}{body}"


def test_iban_ends_at_its_length_whatever_follows(frame):
    rng = random.Random(3)
    own = ["ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "BE68 5390 0754 7034"]
    own += [iban(c, "".join(rng.choice("0123456789") for _ in range(n - 4))) for c, n in [
        ("NO", 15), ("BE", 16), ("NL", 18), ("AT", 20), ("DE", 22), ("ES", 24), ("SE", 24), ("CZ", 24),
        ("RO", 24), ("SK", 24), ("PT", 25), ("FR", 27), ("PL", 28), ("HU", 28), ("MT", 31), ("LC", 32)]]
    own += [" ".join(x[i:i + 4] for i in range(0, len(x), 4)) for x in own[3:]]
    tails = ["", " Please", " BIC CAIXESBB", " Thanks", " A", " 12", " OK 7", ".", " 2024-01-02", " X1 Y2Z3"]
    heads = ["", "to ", "REF12 ", "AB12 ", "x: "]
    texts = [(h, x, t) for x in own for h, t in [("", t) for t in tails] + [(h, " Please") for h in heads]]
    texts += [("", own[0], " " + own[2] + " " + own[0] + " end")]
    got, taken = by_id(find_pii(frame(numbered([h + x + t for h, x, t in texts])))), 0
    for i, (h, x, t) in enumerate(texts):
        found = [(f["kind"], f["start"], f["value"]) for f in got[i].findings if f["kind"] == "iban"]
        # Digits that happen to be a card or phone are a base span, which goes first.
        base = any(f["kind"] in RULES for f in got[i].findings)
        assert base or found[:1] == [("iban", len(h), x)], (h + x + t, found)
        taken += base
    assert taken < len(texts) // 10
    assert [f["value"] for f in got[len(texts) - 1].findings] == [own[0], own[2], own[0]]
    wrong = ["ES91 2100 0418 4502 0005 1333 Please", "ES91 2100 0418 4502 0005 1332Please",
             "xES91 2100 0418 4502 0005 1332", "BE68 5390 0754 70347"]
    got = by_id(find_pii(frame(numbered(wrong))))
    assert not any(f["kind"] == "iban" for r in got.values() for f in r.findings)
    out = by_id(redact_pii(frame(numbered([own[0] + " Please", own[1] + " BIC CAIXESBB"]))))
    assert [out[i].text for i in (0, 1)] == ["<IBAN> Please", "<IBAN> BIC CAIXESBB"]


def test_added_span_inside_a_base_span_is_dropped(frame):
    r = by_id(find_pii(frame(numbered(["call +1 555 123 4567 now"]))))[0]
    assert [x["kind"] for x in r.findings] == ["phone"]


def test_many_matches_in_one_text(frame):
    text = "x@y.zz, " * 20000
    r = by_id(pii_report(frame(numbered([text]))))[0]
    assert r.n_email == 20000 and r.spans.endswith(f"email:{8 * 19999}:{8 * 19999 + 6}")


def test_redaction_leaves_no_base_span(frame):
    rng = random.Random(8)
    pieces = list("0123456789 -.+@ab(") + ["user@h.com ", " +49 170 1234567 ", " 1.2.3.4 ", "word "]
    texts = FIXED + ["".join(rng.choice(pieces + [" " + card(rng, 16) + " "])
                             for _ in range(rng.randrange(1, 30))) for _ in range(200)]
    src = frame(numbered(texts))
    out = redact_pii(src)
    assert out.columns == src.columns and out.schema == src.schema
    got = by_id(out)
    for i, t in enumerate(texts):
        if t is None:
            assert got[i].text is None
            continue
        assert not brute(got[i].text)[1], (t, got[i].text)
        if not brute(t)[1] and not re.search("[0-9]", t):
            assert got[i].text == t
    assert got[5].text == "<CARD> x <PHONE>." and got[5].score == "x"


def test_no_character_of_a_span_survives_redaction(frame):
    fixed = ["call +33.1.42.68.53.00", "4111 1111 1111 1111@x.com", "call +1.2.3.4.55.66 é😀 x@y.zz.",
             "a@b.cc " * 700 + "+33.1.42.68.53.00", "4111111111111111 10.0.0.1", "4111111111111111.1.2.3.4"]
    rng = random.Random(11)
    pieces = list("0123456789 -.+@()é😀") + ["user@h.com", "+33.1.42.68.53.00", "1.2.3.4", " ", " call "]
    texts = fixed + ["".join(rng.choice(pieces + [card(rng, 16)]) for _ in range(rng.randrange(1, 40)))
                     for _ in range(300)]
    src = frame(numbered(texts))
    got, found = by_id(redact_pii(src)), by_id(find_pii(src))
    shared = 0
    for i, t in enumerate(texts):
        marked = list(t)
        for x in found[i].findings:
            shared += "\0" in marked[x["start"]:x["end"]]
            marked[x["start"]:x["end"]] = "\0" * (x["end"] - x["start"])
        # What stands between the masks comes, in order, from the text outside all spans.
        outside, at = "".join(marked), 0
        for piece in re.split("<[A-Z_]+>", got[i].text):
            assert (at := outside.find(piece, at)) >= 0, (t, got[i].text)
            at += len(piece)
        if not found[i].findings:
            assert got[i].text == t
    assert shared > 20
    assert [got[i].text for i in (0, 1)] == ["call <PHONE>", "<CARD>"]
    assert got[2].text == "call <PHONE> é😀 <EMAIL>." and got[3].text == "<EMAIL> " * 700 + "<PHONE>"
    assert [got[i].text for i in (4, 5)] == ["<CARD> <IP>", "<CARD>.<IP>"]


def test_empty_table(frame):
    assert pii_report(frame([])).count() == 0 and redact_pii(frame([])).count() == 0


def test_no_python_in_the_plan(frame):
    plan = pii_report(frame(numbered(["a"])))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_sql_equals_the_operator_on_added_kinds(lspark):
    """Context words beyond earlier matches, IBANs beside other words, lists of numbers."""
    import duckdb

    from stratum.llm.pii import pii_report
    from stratum.llm.sql import SQL

    texts = [
        "call 555-123-4567 or 555-987-6543", "ES91 2100 0418 4502 0005 1332 Please", None, "",
        "amex card exp 12/27 no 378282246310005", "ES9121000418450200051332 BIC CAIXESBB",
        "BE68 5390 0754 7034 Thanks", "BE68539007547034 ES91 2100 0418 4502 0005 1332 and GB82 WEST 1234 5698 7654 32",
        "iban GB82 WEST 1234 5698 7654 32, DE89370400440532013000.", "xGB82WEST12345698765432 GB82WEST12345698765432x",
        "XX12 3456 7890 1234 ABCD 12 tail", "ssn 123-45-6789, 987-65-4321; social security 078-05-1120 000-12-3456",
        "tel (555) 123-4567 555.123.4567 a@b.co 1.2.3.4 +33 1 42 68 53 00 4111 1111 1111 1111",
        "é😀 call 555-123-4567 ü 555 987 6543", "GB82 WEST GB82 WEST 1234 5698 7654 32 WEST",
        "card 30569309025904 and 371449635398431 mobile 555-000-1111 " * 3,
        "NO93 8601 1117 947 NO9386011117947 MT84 MALT 0110 0001 2345 MTLC AST0 01S end",
        "word " * 30 + "call 555-123-4567" + " x" * 30 + " 555-987-6543"]
    rng = random.Random(12)
    parts = ["call ", "card ", "ssn ", "iban ", "555-123-4567", "378282246310005", "123-45-6789", "BE68 5390 0754 7034",
             "ES9121000418450200051332", "GB82 WEST 1234 5698 7654 32", " ", ", ", "A1 ", "AB12 ", "x", "12/27 ", "é"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(3, 14))) for _ in range(300)]
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in pii_report(lspark.createDataFrame(rows, "doc_id long, text string")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(SQL["op1_pii"]).fetchall())
    assert got == want and sum(r[-1] for r in got) > 100
