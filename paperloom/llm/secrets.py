"""Secret scans by dictionary-primed zstandard novelty.

A candidate is a string in a sensitive context: what follows a name such as token or password (all of
a quoted string, or the run of non-blanks), the password in a URL, or one of a few well-known shapes. A
zstandard compressor is primed with a dictionary of identifiers and placeholders followed by the text
around the candidate, AROUND characters on either side, the candidate itself taken out. The bytes that
the candidate still costs are its novelty: names and placeholders are found in the dictionary and cost
little; a random key has no match anywhere. Candidates that stay incompressible are reported,
whatever characters they consist of.

The identifiers come from the corpus: parts of the identifiers in all documents are counted by the
different surroundings they occur in (so a secret in a thousand copies of a page counts once), and the
most frequent fill DICTIONARY_BYTES. Words (of prose in a quoted string, and parts of an unquoted
identifier that can be spoken) aren't measured.

Two narrow passes, of which the first shuffles counts alone: Arrow's regular expressions pick the texts
over whole columns, and only those reach Python. The whole text is scanned; a value may have any length.

Defined results: null and empty texts have no finding and stay as they are; a value that occurs
twice is found twice; candidates don't overlap: the first ends before the next begins; repeated rows and
rows with a null doc_id are found each; other columns are carried along by ``redacted``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import slices

NAMES = "token|secret|passw(?:or)?d|passwd|pwd|passphrase|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|client[_-]?secret|credential|bearer|signature"
#: For Arrow: texts that may hold a candidate.
HINT = r"(?i)(" + NAMES + r"|\b(?:AKIA|ASIA)[0-9A-Z]{16}|\bgh[opsu]_[0-9A-Za-z]{20}|\bxox[abprs]-|\beyJ[0-9A-Za-z_-]{10}|-----BEGIN |://[^\s/@:]*:[^\s/@]*@)"
CANDIDATE = regex.compile(
    r"(?P<assigned>(?i:(?:" + NAMES + r")[A-Za-z0-9_-]*+)[\"']?(?:\s*+(?:=>|:=|[=:>])\s*+|\s++)(?:(?P<quote>[\"'`])(?P<quoted>(?:(?!(?P=quote))[^\r\n])++)(?P=quote)|[\"'`]?(?P<value>[^\s\"'`<>]++)))"
    r"|(?P<cloud>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)|(?P<forge>\bgh[opsu]_[0-9A-Za-z]{20,}+)|(?P<chat>\bxox[abprs]-[0-9A-Za-z-]{10,}+)"
    r"|(?P<web>\beyJ[0-9A-Za-z_-]{10,}+\.[0-9A-Za-z_-]{10,}+\.[0-9A-Za-z_-]{10,}+)"
    r"|(?P<url>(?<=://[^\s/@:]*:)[^\s/@]++(?=@))"
    r"|(?P<pem>-----BEGIN [A-Z ]*+(?<=PRIVATE KEY)-----[\s\S]*?-----END [A-Z ]*+(?<=PRIVATE KEY)-----)"
)
#: What an unquoted value, or one whose quote isn't closed on its line, consists of.
UNQUOTED = regex.compile(r"[^\s\"'`<>]++")
#: A sensitive name with a value of its own.
INNER = regex.compile(r"(?i:" + NAMES + r")[A-Za-z0-9_-]*+[\"']?\s*+(?:=>|:=|[=:])[^=\s]")
SHAPES = ("cloud", "forge", "chat", "web", "url", "pem")
#: Identifiers, keywords and placeholders that code and configuration hold.
IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 9876543210 123e4567-e89b-12d3-a456-426614174000 deadbeef cafebabe "
    "password passwd secret token api_key apikey access_key access_token auth_token client_secret client_id private_key public_key bearer authorization credential credentials "
    "username user admin root guest test testing example sample dummy placeholder changeme change_me letmein qwerty default unknown undefined null none true false empty redacted removed hidden xxxxxxxxxxxxxxxx **************** "
    "your_token_here your-api-key-here YOUR_API_KEY YOUR_SECRET_KEY insert_key_here my_secret_password mypassword password123 Password123! secret123 test_token example_token fake_token dummy_secret "
    "os.environ process.env getenv config settings options parameters request response session database connection string hostname localhost endpoint service_account username_or_email file path "
    "function return import from class def self this const let var public static void new void int float double string bool boolean list dict map set get put post delete update create select insert where value values key keys name names type types id index "
    "https://www.example.com/path http://localhost:8080 api.example.com user@example.com application/json text/html utf-8 base64 sha256 sha1 md5 hmac aes rsa ssh-rsa jwt oauth2 "
).encode()
#: Characters of text on either side that prime the compressor.
AROUND = 4096
LEVEL = 9
#: Bytes of corpus identifiers in the dictionary, and in how many different surroundings each must occur.
DICTIONARY_BYTES = 16 << 10
MIN_SURROUNDINGS = 20
#: Identifiers of several parts, or before a sign of assignment.
IDENTIFIER_HINT = r"[0-9A-Za-z]_[0-9A-Za-z]|[a-z][A-Z]|[A-Za-z][\"']? ?=|[A-Za-z][\"'] ?:"
IDENTIFIER = regex.compile(r"(?<![\p{L}\p{N}_])(?:[A-Z]?[a-z0-9]++[A-Z][A-Za-z0-9_]*+|[A-Za-z0-9]*+_[A-Za-z0-9_]++|[A-Za-z][A-Za-z0-9]*+(?=[\"']? ?=|[\"'] ?:))(?![\p{L}\p{N}_])")
PART = regex.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")
#: A finding costs at least so many bytes (the first for letters or digits alone), and this share of its length, or the entropy bound of its alphabet if that is less.
MIN_BYTES, MIN_MIXED = 12, 8
MIN_SHARE = 0.62
ALPHABETS = tuple((math.log2(n) / 8, regex.compile(p)) for n, p in ((10, r"[0-9]+"), (16, r"[0-9a-f]+|[0-9A-F]+"), (26, r"[a-z]+|[A-Z]+")))
#: Words of prose in a quoted value, with their punctuation; they aren't measured.
WORD = regex.compile(r"(?<!\S)[\"'(\[]*(?:\p{Lu}?\p{Ll}*|\p{Lu}+)(?:['’-]\p{L}+)*[.,;:!?\"')\]]*(?!\S)")
#: Parts of an unquoted identifier that can be spoken: with a vowel, and at most four consonants together.
SPOKEN = regex.compile(r"(?<![A-Za-z])[a-z]{3,}(?![a-z])|[A-Z][a-z]{2,}|(?<=[A-Z][a-z]*|_)[a-z]{3,}(?![a-z])|(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])")
#: Random strings hold short letter runs between digits; beside a digit, a word has four letters at least.
HEX = regex.compile(r"(?=[^0-9]*[0-9])(?:[0-9a-f]+|[0-9A-F]+)")
VOWEL, HARD = regex.compile(r"(?i)[aeiouy]"), regex.compile(r"(?i)[b-df-hj-np-tv-xz]{5}")
FINDINGS = "doc_id bigint, kind string, start bigint, length bigint, marginal_bytes bigint, share double, sha256 string"


def novelty(value: str, before: str, after: str, identifiers: bytes = IDENTIFIERS) -> int:
    """Bytes that ``value`` adds to its surroundings."""
    around = (after + "\n" + before).replace(value, "").encode("utf-8", "surrogatepass")
    primed = zstandard.ZstdCompressionDict(identifiers + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    c = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
    return len(c.compress(value.encode("utf-8", "surrogatepass"))) - len(c.compress(b""))


def bound(value: str) -> float:
    """The least share of its length that a random string of the value's alphabet costs, MIN_SHARE at most."""
    return min([MIN_SHARE, *(share for share, p in ALPHABETS if p.fullmatch(value))])


def judged(text: str, a: int, b: int, measured: str, identifiers: bytes) -> int:
    """The novelty of the candidate between a and b, of which ``measured`` counts; 0 if it is no finding."""
    value, size = text[a:b], len(measured.encode("utf-8", "surrogatepass"))
    least = MIN_BYTES if measured.isalpha() or measured.isdigit() else MIN_MIXED
    if size < least:
        return 0
    cost = novelty(measured, text[max(0, a - AROUND) : a].replace(value, ""), text[b : b + AROUND].replace(value, ""), identifiers)
    return cost if cost >= least and cost >= bound(measured) * size else 0


def unspoken(value: str) -> str:
    """An unquoted value without the parts that are words; all of it where they are the lesser part, or where it is hex."""
    if HEX.fullmatch(value):
        return value

    def part(m: regex.Match) -> str:
        a, b = m.span()
        beside = value[max(0, a - 1) : a].isdigit() or value[b : b + 1].isdigit()
        return "" if VOWEL.search(m[0]) and not HARD.search(m[0]) and (len(m[0]) >= 4 or not beside) else m[0]

    rest = SPOKEN.sub(part, value)
    return value if 2 * len(rest) > len(value) else rest


def found(text: str, identifiers: bytes = IDENTIFIERS) -> list[tuple[str, int, int, int]]:
    """Kind, start, end and novelty of each finding, in order."""
    out = []
    at = 0
    while m := CANDIDATE.search(text, at):
        at = m.end()
        if shape := next((k for k in SHAPES if m[k]), None):
            a, b = m.span()
            cost = judged(text, a, b, text[a:b], identifiers)
        else:
            cost = 0
            if m["quoted"] is not None:
                a, b = m.span("quoted")
                value = m["quoted"]
                cost = judged(text, a, b, " ".join(WORD.sub("", value).split()) if any(c.isspace() for c in value) else value, identifiers)
            if not cost and (v := UNQUOTED.match(text, m.start("value") if m["quoted"] is None else a)):
                at = a = v.start()  # what lies in the value may be a finding
                b = a + len(v[0].rstrip("=.,;:!?)]}"))
                if not INNER.search(text[a:b]):
                    cost = judged(text, a, b, unspoken(text[a:b]), identifiers)
                    if cost:
                        at = v.end()
        if cost:
            out.append((shape or "assigned", a, b, cost))
    return out


def corpus_identifiers(docs: DataFrame) -> bytes:
    """IDENTIFIERS after the parts of identifiers that occur in most surroundings in the corpus, least first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[str, int]] = set()
            text = batch.column(0)
            for i in pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(text, IDENTIFIER_HINT), False)).to_pylist():
                whole = text[i].as_py()
                for m in IDENTIFIER.finditer(whole):
                    a, b = m.span()
                    around = xxhash.xxh3_64_intdigest((whole[max(0, a - 16) : a] + "\0" + whole[b : b + 16]).encode("utf-8", "surrogatepass")) >> 1
                    seen.update((part, around) for part in PART.findall(m[0]))
            rows = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([y for _, y in rows], pa.int64())], names=["part", "around"])

    counted = docs.select("text").mapInArrow(run, "part string, around bigint").distinct().groupBy("part").count().filter(F.col("count") >= MIN_SURROUNDINGS)
    # a part has two letters at least
    most = [r["part"] for r in counted.orderBy(F.desc("count"), "part").limit(DICTIONARY_BYTES // 3).collect()]
    return " ".join(reversed(most)).encode()[-DICTIONARY_BYTES:] + b" " + IDENTIFIERS


def hinted(text: pa.Array) -> list[int]:
    """Rows that may hold a candidate."""
    hits = pc.fill_null(pc.match_substring_regex(text, HINT), False)
    return pc.indices_nonzero(hits).to_pylist()


def findings(docs: DataFrame) -> DataFrame:
    """A row a finding; the secret itself only as a SHA-256."""
    identifiers = corpus_identifiers(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            text = batch.column(1)
            for i in hinted(text):
                whole = text[i].as_py()
                for kind, a, b, cost in found(whole, identifiers):
                    raw = whole[a:b].encode("utf-8", "surrogatepass")
                    rows.append((batch.column(0)[i].as_py(), kind, a, b - a, cost, cost / len(raw), hashlib.sha256(raw).hexdigest()))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in FINDINGS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, FINDINGS)


def redact(text: str, mark: str = "[SECRET]", identifiers: bytes = IDENTIFIERS) -> str:
    at, parts = 0, []
    for _, a, b, _ in found(text, identifiers):
        parts += [text[at:a], mark]
        at = b
    return "".join([*parts, text[at:]]) if parts else text


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every finding replaced by a mark; all rows and columns stay."""
    place = docs.columns.index("text")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    identifiers = corpus_identifiers(plain.select(F.col(f"c{place}").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, f"c{place}"):
                text = part.column(place)
                if new := {i: redact(text[i].as_py(), identifiers=identifiers) for i in hinted(text)}:
                    mask = np.zeros(len(text), bool)
                    mask[list(new)] = True
                    text = pc.replace_with_mask(text, pa.array(mask), pa.array([new[i] for i in sorted(new)], text.type))
                columns = [text if i == place else part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return plain.mapInArrow(run, plain.schema).toDF(*names)
