"""Secrets in texts: fixed patterns, and strings that compression finds novel.

A candidate is a long string of letters and digits that a sensitive name is
given, or that stands after one. Zstandard, primed with a dictionary of common
identifiers and of the code around the candidate, tells how many bytes the
candidate adds. Identifiers, words and values that the surroundings know add
few; a random key adds nearly its own length. So do words that the dictionary
lacks, paths, dates and file names: so enough of the candidate must also lie in
parts that are no words, pair of letters by pair, and no numbers beside words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from math import log2

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from crowdpulse.llm.frames import batched, picked

KINDS = ("assign", "access", "hex", "novel")
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
WINDOW = 256
CONTEXT = 48
NOVELTY = 0.7
LETTER_BITS = 5.2
MARK = "<secret>"

# Letters A to Z only, in either case.
_ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LENGTH - 4},}}")
_HEX = re.compile(rf"[0-9a-f]{{{HEX_LENGTH},}}")
_TRIGGERS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A sign = ends a name; only at the end it is the padding of a value.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
# Names of secrets, or parts of such names.
_NAMES = (
    "password passwd passphrase pwd secret token key keys apikey secretkey privatekey accesskey authkey "
    "accesstoken authtoken credential credentials auth authorization bearer private signature salt"
).split()
# As whole parts of a name: api_key, apiKey, API-KEY, but not keyboard, monkey or author.
_PART = "|".join(
    f"(?<![A-Za-z]){name}(?![a-z])|(?<![A-Z]){name.title()}(?![a-z])|(?<![A-Za-z]){name.upper()}(?![A-Za-z])"
    for name in _NAMES
)
_SENSITIVE = re.compile(_PART)
# The name that a value is given to, at the end of the text before it.
_GIVEN = re.compile(r"""([A-Za-z][\w.-]*)["'\])]*\s*(?:[:=]|:=|=>)\s*["'(\[]*(?:(?:[Bb]earer|[Bb]asic)\s+)?$""")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_LONG_PART, _LONG_WORD, _LONG_PIECE, _TURNS = 8, 12, 6, 3
# Words beside numbers are names more often than not, so their letters must be still less likely.
PIECE_BITS = 5.9
#: Letters and digits in random parts that a value needs, and their share of all, if a name is given
#: it, and if a sensitive name only stands before it.
GIVEN_RANDOM, NEAR_RANDOM = (8, 0.5), (16, 0.75)
# Identifiers that often stand around configuration values.
IDENTIFIERS = (
    "password passwd passphrase secret secret_key token access_token refresh_token id_token api_key "
    "apikey apiKey access_key access_key_id secret_access_key private_key public_key client_id "
    "client_secret credential credentials authorization Authorization Bearer Basic auth signature "
    "username user_name user_id session_id request_id transaction_id config configuration settings "
    "environment production development staging localhost example default description "
    "implementation initialize initialization connection connection_string database_url endpoint "
    "https://www.example.com/index.html function return import export public static const string "
    "true false none null undefined 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "00000000-0000-0000-0000-000000000000 1234567890 xxxxxxxxxxxxxxxxxxxx AAAAAAAAAAAAAAAAAAAA"
)
# Fixed value: common words of four languages, for the pairs of letters in them.
WORDS = (
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an "
    "they which one you were her all she there would their we him been has when who will more no if out so "
    "said what up its about into than them can only other new some could time these two may then do first "
    "any my now such like our over man me even most made after also did many before must through back years "
    "where much your way well down should because each just those people how too little state good very make "
    "world still own see men work long get here between both life being under never day same another know "
    "while last might us great old year off come since against go came right used take three "
    "international information understanding development responsibility characteristic organization "
    "communication environment government relationship particularly application configuration description "
    "keyboard authentication authorization implementation transformation straightforward acknowledgement "
    "password string number value function object default index user file path server client request "
    "response handler manager factory service connection session message content document element event "
    "src main java com org net www http html app lib bin usr etc local share home opt var tmp test "
    "button window image header settings context provider component controller repository exception "
    "der die und das von den mit ist des sich auf ein eine nicht als auch werden aus hat dass sie nach wird "
    "bei einer um noch wie einem haben nur oder aber vor zur bis mehr durch man sein wurde sei gegen vom "
    "schon wenn habe seine uhr ihre dann unter wir soll ich eines jahr zwei jahren diese dieser wieder keine "
    "gesellschaft verwaltung wissenschaft entwicklung geschwindigkeit schiff fahrt versicherung haupt "
    "schluessel verfahren bundes regierung arbeit leistung zusammen berechtigung freundschaft moeglichkeit "
    "le de un etre et en avoir que pour dans ce il qui ne sur se pas plus par je avec tout faire son mettre "
    "autre on mais nous comme ou si leur elle devoir avant deux meme prendre aussi celui donner bien encore "
    "gouvernement developpement malheureusement environnement particulierement naturellement connaissance "
    "el la que y los del las por con no una su para es al lo mas pero sus ya o fue este ha porque esta son "
    "entre cuando muy sin sobre ser tiene tambien me hasta hay donde han quien estan desde todo nos durante "
    "todos uno les contra otros ese eso habia ante ellos informacion responsabilidad desarrollo conocimiento"
)

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start and then by kind."""
    spans: list[Span] = []
    low = text.lower()
    if any(trigger in low for trigger in _TRIGGERS):
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGN_VALUE:
                spans.append((match.start(), 0, match.end()))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def novelty(text: str, start: int, end: int) -> float:
    """Bytes that the string adds to its compressed surroundings, over its own bytes.

    The dictionary holds the identifiers and the text around; other copies of
    the string itself are taken out, so that a repeated secret stays novel.
    """
    value = text[start:end]
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    around = f"{IDENTIFIERS} {after} {before}".replace(value, " ").encode("utf-8", "replace")
    primed = zstandard.ZstdCompressor(
        level=3,
        dict_data=zstandard.ZstdCompressionDict(around, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    lead = before[-CONTEXT:].replace(value, " ").encode("utf-8", "replace")
    raw = value.encode()
    return (len(primed.compress(lead + raw)) - len(primed.compress(lead))) / len(raw)


_WORD_ENDS = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")


@cache
def _pair_bits() -> dict[str, float]:
    """Bits that the second letter takes after the first; a space stands for both ends of a word."""
    text = f" {' '.join(WORDS.split())} "
    pairs, firsts = Counter(map("".join, zip(text, text[1:]))), Counter(text[:-1])
    signs = " abcdefghijklmnopqrstuvwxyz"
    return {a + b: -log2((pairs[a + b] + 0.3) / (firsts[a] + 0.3 * len(signs))) for a in signs for b in signs}


def letter_bits(value: str) -> float:
    """Bits that each letter takes if the string were words, split at signs and capitals."""
    words = f" {_WORD_ENDS.sub(' ', value).strip().lower()} "
    bits = _pair_bits()
    return sum(bits[a + b] for a, b in zip(words, words[1:]) if a != " " or b != " ") / max(
        1, sum(c != " " for c in words)
    )


def _is_random(part: str) -> bool:
    """A run of letters and digits that is no word, number, or words and numbers together."""
    if part.isdigit():
        return False
    if part.isalpha():
        return len(part) >= _LONG_WORD and letter_bits(part) >= LETTER_BITS
    if len(part) < _LONG_PART:
        return False
    pieces = re.findall("[A-Za-z]+|[0-9]+", part)
    odd = any(len(p) >= _LONG_PIECE and p.isalpha() and letter_bits(p) >= PIECE_BITS for p in pieces)
    return odd or len(pieces) > _TURNS


def random_share(value: str) -> tuple[int, float]:
    """How many letters and digits lie in random parts between signs, and their share of all."""
    parts = re.findall("[A-Za-z0-9]+", value)
    found = sum(len(part) for part in parts if _is_random(part))
    return found, found / max(1, sum(map(len, parts)))


def _looks_random(value: str, given: bool) -> bool:
    least, share = GIVEN_RANDOM if given else NEAR_RANDOM
    if not given and _UUID.fullmatch(value):
        return False
    found, part = random_share(value)
    return found >= least and part >= share


def novel_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates in sensitive context that look random, are novel and overlap no span of `base`.

    The context is a sensitive name that the value is given to, or, for values
    that are random almost throughout, one in the WINDOW before it.
    """
    spans: list[Span] = []
    last = -1
    for match in _CANDIDATE.finditer(text):
        start, end = match.span()
        value = match[0]
        if value.isdigit():
            continue
        # The lines of one long key stand below each other.
        given = last >= 0 and not text[last:start].strip()
        if not given:
            before = text[max(0, start - WINDOW) : start]
            if not _SENSITIVE.search(before):
                continue
            name = _GIVEN.search(before)
            given = bool(name and _SENSITIVE.search(name[1]))
        if any(low < end and start < high for low, _, high in base):
            continue
        if _looks_random(value, given) and novelty(text, start, end) >= NOVELTY:
            spans.append((start, 3, end))
            last = end
    return spans


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(fixed patterns, all spans), each by start and then by kind."""
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced by MARK."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MARK]
        at = max(at, end)
    return "".join(out) + text[at:]


_REPORT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_novel long"
)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _REPORT.split(", ")]
    kinds = [pa.string() if "string" in part else pa.int64() for part in _REPORT.split(", ")]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            base, spans = find(text.as_py() or "")
            count = [sum(kind == k for _, kind, _ in spans) for k in range(4)]
            digest = sha256(joined(base).encode()).hexdigest()
            rows.append((doc_id, *count[:3], digest, joined(spans), count[3]))
        columns = list(zip(*rows)) or [[]] * len(names)
        arrays = [pa.array(column, type=kind) for column, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def scan(documents: DataFrame) -> DataFrame:
    """Per document the number of spans of each kind, a digest of the fixed ones, and all spans.

    Spans are kind:start:end in code points, end exclusive, by start and then
    by kind in the order of KINDS, joined by commas. A null text counts as
    empty, an empty one has no spans. Every row is read on its own, so repeated
    rows repeat their result. Only doc_id and text are read.
    """
    return picked(documents, doc_id="long", text="string").mapInArrow(_report, _REPORT)


def redact(documents: DataFrame) -> DataFrame:
    """The same rows and columns, secrets in `text` replaced by MARK, `n_chars` (if any) recounted.

    A null text stays null; a text without secrets stays as it is.
    """

    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            new = [t if not t else masked(t, find(t)[1]) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(new, type=pa.string())
            if "n_chars" in batch.schema.names:
                place = batch.schema.get_field_index("n_chars")
                kept = columns[place].to_pylist()
                sizes = [n if a == b else len(b) for a, b, n in zip(texts, new, kept)]
                columns[place] = pa.array(sizes, type=columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return batched(documents, masks, documents.schema)
