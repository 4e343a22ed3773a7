"""Column expressions against Python's own str, float, csv, email, json and datetime on random input."""

import csv as pycsv
import email as pyemail
import email.policy
import io
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.dates import reformat_date
from docspark.functions.render import py_repr, py_str, sorted_json_fields
from docspark.functions.text import WHITESPACE, collapse_blanks, html_to_text, java_regex, parse_float, strip, tags_to_blanks, word_count
from docspark.operators.enrich import EMAIL, text_stats
from docspark.operators.normalize import to_list
from docspark.sources import csv, email as mails

rng = random.Random(7)
ALPHABET = "ab,;|\"'\\é ß€😀<>&=:0123456789_-+.\n\t\r\x0b\x0c\x00\x01\x1c\x1f\x7f\x85\xa0  　​"


def texts(n, longest=30, alphabet=ALPHABET):
    return ["", " ", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n))]


def apply(spark, values, dtype, *exprs):
    df = spark.createDataFrame(list(enumerate(values)), T.StructType([T.StructField("i", T.LongType()), T.StructField("x", dtype)]))
    rows = df.select("i", *[e(F.col("x")).alias(f"r{k}") for k, e in enumerate(exprs)]).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r["i"])]


def test_whitespace_set_is_complete():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_and_word_count(spark):
    values = texts(3000)
    for v, (stripped, words) in zip(values, apply(spark, values, T.StringType(), strip, word_count)):
        assert stripped == v.strip(), repr(v)
        assert words == len(v.split()), repr(v)


def test_collapse_blanks(spark):
    import re

    def slow(v):
        v = re.sub("[\t\r\x0b\x0c]+", " ", v)
        v = re.sub(" {2,}", " ", v).strip()
        return "".join(ch for ch in v if not (ch < "\x09" or "\x0e" <= ch <= "\x1f" or ch == "\x7f"))

    values = texts(3000)
    for v, (got,) in zip(values, apply(spark, values, T.StringType(), collapse_blanks)):
        assert got == slow(v), repr(v)


def test_parse_float(spark):
    values = texts(4000, 6, "0123456789._-+eE nainft,d$") + [
        "1_000", "1__0", "_1", "1_", "1e5", "1.e-3", ".5", ".", "-.5e+1_0", "inf", "-Infinity", "+NaN", " 7 ", " 1\n", "1f", "0x10", "1e400", "١",
    ]
    for v, (got,) in zip(values, apply(spark, values, T.StringType(), parse_float)):
        try:
            want = float(v)
        except ValueError:
            want = None
        if v == "١":  # digits of other scripts are left out
            continue
        assert (got is None) == (want is None), repr(v)
        assert got is None or got == want or (got != got and want != want), repr(v)


def test_broken_utf8(spark):
    pieces = [0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0x41, 0xC0, 0xF5]
    values = [bytes(rng.choice([rng.randrange(256), *pieces]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    got = apply(spark, values, T.BinaryType(), lambda c: F.make_valid_utf8(c.cast("string")))
    assert [g[0] for g in got] == [v.decode("utf-8", "replace") for v in values]


def test_floats_and_other_values_as_text(spark):
    values = [0.0, -0.0, 1.0, 100.0, 0.1, 1e7, 12345678.9, 1e15, 123456789012345680.0, 1e16, 1.5e16, 1e-4, 0.00012, 1e-5, 1.5e-7, -2.5e20, 1e300,
              float("nan"), float("inf"), float("-inf"), *[rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20) for _ in range(2000)]]
    for v, (text,) in zip(values, apply(spark, values, T.DoubleType(), lambda c: py_str(c, T.DoubleType()))):
        if text != str(v):  # JDK 17 sometimes prints one digit more than needed; it must still be the same number
            assert float(text) == v and ("e" in text) == ("e" in str(v)), (v, text)
    stamps = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60)]
    got = apply(spark, stamps, T.TimestampNTZType(), lambda c: py_str(c, T.TimestampNTZType()))
    assert [g[0] for g in got] == [str(s) for s in stamps]


def test_repr_of_strings(spark):
    values = texts(3000)
    for v, (got,) in zip(values, apply(spark, values, T.StringType(), lambda c: py_repr(c, T.StringType()))):
        assert got == repr(v).replace("\\u200b", "\\u200b"), repr(v)


def test_sorted_json(spark):
    schema = T.StructType([
        T.StructField("i", T.LongType()), T.StructField("b", T.StringType()), T.StructField("a", T.DoubleType()), T.StructField("Z", T.BooleanType()),
        T.StructField("é", T.ArrayType(T.StringType())), T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        T.StructField("s", T.StructType([T.StructField("y", T.LongType()), T.StructField("x", T.StringType())])),
    ])
    rows = []
    for i, t in enumerate(texts(800)):
        rows.append((i, t, i / 7 if i % 5 else None, [True, False, None][i % 3], [t, None, "x"][: i % 4], {t: i, "k": None}, {"y": i, "x": t} if i % 2 else None))
    df = spark.createDataFrame(rows, schema)
    fields = {f.name: (F.col(f"`{f.name}`"), f.dataType) for f in schema.fields}
    got = df.select("i", sorted_json_fields(fields).alias("all"), sorted_json_fields(fields, drop_null=True).alias("some")).collect()
    for r in got:
        record = dict(zip(schema.names, rows[r["i"]]))
        assert r["all"] == json.dumps(record, sort_keys=True)
        assert r["some"] == json.dumps({k: v for k, v in record.items() if v is not None}, sort_keys=True)


def test_long_hostile_texts(spark):
    """Neither deep recursion nor quadratic time on large inputs."""
    values = ["1_" * 100_000 + "1", "a" * 500_000 + "@", "<" * 20_000, "a@" * 200_000, "1" * 300_000, "\t " * 200_000]
    got = apply(spark, values, T.StringType(), parse_float, lambda c: text_stats(c), html_to_text, collapse_blanks, tags_to_blanks)
    assert got[0][0] == float("inf") and [g[1]["has_email"] for g in got] == [False] * 6
    assert got[2][2] == values[2] and got[5][3] == "" and got[3][4] == values[3]
    assert apply(spark, ["x" * 300_000 + "@y.z"], T.StringType(), text_stats)[0][0]["has_email"]


def test_emails(spark):
    import re

    values = texts(3000, 12, "aé_.-@1 \n")
    got = apply(spark, values, T.StringType(), lambda c: c.rlike(EMAIL))
    assert [g[0] for g in got] == [bool(re.search(r"[\w.-]+@[\w.-]+\.\w+", v)) for v in values]


def test_lists(spark):
    values = texts(2000)
    for v, (got,) in zip(values, apply(spark, values, T.StringType(), lambda c: to_list(c, T.StringType()))):
        first = next((d for d in ",;|\n" if d in v), None)
        want = [v] if first is None else [x.strip() for x in v.split(first) if x.strip()]
        assert got == want, repr(v)


FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y", "%b %d, %Y", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S"]


def test_dates(spark):
    values = []
    for _ in range(6000):
        d = datetime(rng.randint(1000, 2100), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59), rng.randint(0, 59))
        text = d.strftime(rng.choice(FORMATS))
        if rng.random() < 0.3:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice("0129/- ,TxM") + text[k + 1:]
        values.append(rng.choice(["", " "]) + text.replace("/0", "/").upper() if rng.random() < 0.3 else text)
    values += ["2024-02-30", "13/13/2024", "31/12/2024", "1/2/2024", "0000-01-01", "24-01-01", "Sept 1, 2024", "2024-1-1 24:00:00", "2024-01-01T10:20:30Z", "May 5, 2024", "2024-01- 5", "1/ 5/2024",
               "2024- 1-05", "1/  5/2024", "2024-01- 0", "2024-01- 5 1:2:3", "May\n 5,\t2024"]

    def slow(v):
        for f in FORMATS:
            try:
                return datetime.strptime(v.strip(), f).strftime("%Y|%d.%m %H:%M:%S %b")
            except ValueError:
                pass
        return v

    got = apply(spark, values, T.StringType(), lambda c: reformat_date(c, "%Y|%d.%m %H:%M:%S %b"))
    for v, (r,) in zip(values, got):
        assert r == slow(v), repr(v)


@pytest.mark.parametrize("pattern", [r"(?P<a>\w)(?P=a)", r"\d+$", r"^.b\Z", r"\bé", r"[^\s]\s\\Z?"])
def test_patterns(spark, pattern):
    import re

    values = ["aa", "éé", "1\n", "ab", "ab\n", "x é", "b \\Z", "١", "a b", "a\rb", "a "]
    got = apply(spark, values, T.StringType(), lambda c: c.rlike(java_regex(pattern)))
    assert [g[0] for g in got] == [bool(re.search(pattern, v)) for v in values]


def slow_csv(text):
    rows = list(pycsv.reader(io.StringIO(text)))
    if not rows:
        return "(empty CSV)", 0, 0
    head, data = rows[0], rows[1:]
    out = ["Columns: " + ", ".join(head), f"Total rows: {len(data)}", ""]
    for i, row in enumerate(data, 1):
        out.append(f"Row {i}: " + " | ".join((head[j] if j < len(head) else f"col_{j}") + f": {v}" for j, v in enumerate(row)))
    return "\n".join(out), len(data), len(head)


def test_csv_documents(spark):
    values = texts(4000, 40, 'ab, "\n') + texts(300, 400, "a,\n") + ["a,b\r\n1,2\r\n", "a\r\n\r\n"]
    df = spark.createDataFrame(list(enumerate(values)), "i long, content string")
    rows = csv.parse(df).collect()
    for r in rows:
        want = slow_csv(values[r["i"]])
        if not want[0].strip():
            want = ("(empty CSV)", *want[1:])
        assert (r["raw_content"], r["meta_row_count"], r["meta_column_count"]) == want, repr(values[r["i"]])


def random_part(depth):
    deep = ["multipart", "multipart", "message/rfc822"] if depth < 6 else []
    kind = rng.choice(["text/plain", "text/html", "application/pdf", *deep[: 1 + (depth > 1) * 2]])
    body = rng.choice(["hello\nworld", "<p>x &amp; <b>y</b>\n</p>", "", "a = b", "--not a mark\n\n--"])
    if kind == "multipart":
        mark = f"m{depth}.{rng.randint(0, 9)}"
        inner = "".join(f"\n--{mark}\n{random_part(depth + 1)}" for _ in range(rng.randint(1, 3)))
        return f'Content-Type: multipart/mixed; boundary="{mark}"\n\n{rng.choice(["", "pre"])}{inner}\n--{mark}--{rng.choice(["", chr(10) + "post"])}'
    if kind == "message/rfc822":
        name = rng.choice(["", "Content-Disposition: attachment; filename=mail.eml\n"])
        return f"Content-Type: message/rfc822\n{name}\nSubject: inner\n" + random_part(depth + 1)
    head = rng.choice([f"Content-Type: {kind}; charset=utf-8\n", f"content-type: {kind}\n", ""])
    if rng.random() < 0.3:
        head += rng.choice(['Content-Disposition: attachment;\n filename="a b.txt"\n', "Content-Disposition: attachment; filename=c.txt\n"])
    if rng.random() < 0.2:
        import base64

        return head + "Content-Transfer-Encoding: base64\n\n" + base64.b64encode(body.encode()).decode()
    if rng.random() < 0.2:
        return head + "Content-Transfer-Encoding: Quoted-Printable\n\n" + rng.choice(["caf=C3=A9=20=E2=82=AC", "a =3D b=\nc", "x=3D\n=C3=A9", "plain"])
    return head + "\n" + body


def slow_mail(text):
    msg = pyemail.message_from_string(text, policy=email_policy)
    texts_, files = [], []
    if not msg.is_multipart():
        payload = msg.get_payload(decode=True)
        return (payload.decode() if payload else msg.get_payload()), []
    for part in msg.walk():
        if part.get_filename():
            files.append(part.get_filename())
        kind, payload = part.get_content_type(), part.get_payload(decode=True)
        if not payload:
            continue
        if kind == "text/plain":
            texts_.append(payload.decode())
        elif kind == "text/html" and not texts_:
            import re

            texts_.append(re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", payload.decode())).strip())
    return "\n".join(texts_), files


email_policy = email.policy.default


def test_mails(spark):
    values = []
    for i in range(1500):
        lead = rng.choice(["From: a@b.com\nTo: c@d.com\n", "Subject: one\n two\n", "Date: Mon, 1 Jan 2024 12:00:00 +0000\n", ""])
        text = lead + random_part(0)
        values.append(text.replace("\n", "\r\n") if i % 4 == 0 else text)
    assert max(v.lower().count("content-type: mu") + v.count("message/") for v in values) > 6
    df = spark.createDataFrame(list(enumerate(values)), "i long, content string")
    for r in mails.parse(df).collect():
        raw = values[r["i"]]
        body, files = slow_mail(raw)
        msg = pyemail.message_from_string(raw, policy=email_policy)
        head = {h: str(msg.get(h, "")) for h in ("From", "To", "Subject", "Date", "Cc")}
        want = f"From: {head['From']}\nTo: {head['To']}\nSubject: {head['Subject']}\nDate: {head['Date']}\n\n{body}"
        want += f"\n\n[Attachments: {', '.join(files)}]" if files else ""
        assert r["raw_content"] == want, raw
        assert r["meta_attachment_count"] == len(files)
