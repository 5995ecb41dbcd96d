"""Column functions on token lines, addresses, messages, names and paths."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Extensions of each language.
LANGUAGES = {
    "C": ["c", "h"],
    "C++": ["c++", "cc", "cp", "cpp", "cxx", "h++", "hh", "hpp", "hxx", "tcc"],
    "Java": ["java"],
    "M4": ["ac", "am"],
    "Rust": ["rs"],
}
MASKED = ("C", "C++", "Java", "Rust")
POSITION = r"^(?:[0-9]+|-):(?:[0-9]+|-)\t"
ADDRESS = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,})"
FORMER = r"(?:^|\n)Former-commit-id: ([0-9a-f]{40})\z"


def _or_null(c: Column) -> Column:
    return F.when(c != "", c)


def blame_parts(line: Column) -> Column:
    """struct(commit_sha, old_path, token) of a blame line; null if it is empty or has no second field."""
    parts = F.split(F.regexp_replace(line, r"\n\z", ""), ";", 3)
    token = F.when(F.size(parts) > 2, F.regexp_replace(parts[2], r"^\t+", "")).otherwise(F.lit(""))
    return F.when(F.size(parts) >= 2, F.struct(parts[0].alias("commit_sha"), parts[1].alias("old_path"), token.alias("token")))


def without_position(token: Column) -> Column:
    return F.regexp_replace(token, POSITION, "")


def classified(token: Column) -> Column:
    """struct(token_type, token_value, is_structural, func_name) of a token line, by rules in order."""
    fields = F.split(token, r"\|")
    parts = [F.regexp_extract(token, r"^(.+?)\|(.+)$", i) for i in (1, 2)]
    s = lambda kind, value, structural, name=None: F.struct(kind.alias("token_type"), value.alias("token_value"), F.lit(structural).alias("is_structural"), (F.lit(None).cast("string") if name is None else name).alias("func_name"))
    empty = F.lit("")
    return (
        F.when(token.startswith("begin_unit"), s(F.lit("begin_unit"), token, 1))
        .when(token.isin("begin_function", "end_function"), s(token, empty, 1))
        .when(token.startswith("DECL|"), s(F.lit("DECL"), F.substring(token, 6, 1 << 30), 1, F.when(F.size(fields) >= 3, F.element_at(fields, -1))))
        .when(token == "|", s(empty, empty, 1))
        .when(token == "", s(F.lit("blank"), empty, 1))
        .when(token.rlike("^(begin|end)_[a-z_]+$"), s(token, empty, 1))
        .when(~token.rlike(r"^.+?\|.+$"), s(F.lit("unknown"), token, 1))
        .otherwise(s(parts[0], parts[1], 0))
    )


def packed_id(c: Column) -> Column:
    """An id as bytes, to be moved: 40 hexadecimal digits as the 20 bytes they name, which no compression of rows finds, and
    any other id as its own bytes with an end that makes them longer."""
    return F.when(c.rlike("^[0-9a-f]{40}\\z"), F.unhex(c)).otherwise(F.concat(c.cast("binary"), F.lit(b"\0" * 21)))


def whole_id(packed: Column) -> Column:
    """The id of packed_id."""
    n = F.octet_length(packed)
    return F.when(n == 20, F.lower(F.hex(packed))).otherwise(F.substring(packed, F.lit(1), n - 21).cast("string"))


def trailer_address(value: Column) -> Column:
    """The bracketed address, else the first bare one, else null."""
    return F.coalesce(_or_null(F.regexp_extract(value, "<([^>]+)>", 1)), _or_null(F.regexp_extract(value, ADDRESS, 1)))


def who(personid: Column, address: Column) -> Column:
    return F.when(personid.isNotNull(), F.concat(F.lit("p:"), personid)).when(address.isNotNull(), F.concat(F.lit("a:"), F.lower(address)))


def former_commit(cid: Column, message: Column) -> Column:
    """The id on the message's last line, else cid."""
    return F.coalesce(_or_null(F.regexp_extract(F.regexp_replace(message, r"\n+\z", ""), FORMER, 1)), cid)


def with_former_commit(message: Column, sha: Column) -> Column:
    """message with the footer: in the trailing block if that holds a trailer, else as a block of its own."""
    inside = F.substring_index(message, "\n\n", -1).rlike(r"(?m)^[\p{Alnum}-]+: *.*$")
    return F.concat(message, F.when(inside, "\n").otherwise("\n\n"), F.lit("Former-commit-id: "), sha)


def without_last_space(c: Column) -> Column:
    return F.regexp_replace(c, r" \z", "")


def email_parts(email: Column) -> Column:
    """struct(lcemail, userid, domain): lower case, cut at the first @."""
    low = F.lower(email)
    at = F.instr(low, "@")
    return F.struct(low.alias("lcemail"), F.when(at > 0, F.substring(low, F.lit(1), at - 1)).otherwise(low).alias("userid"), F.when(at > 0, F.substring(low, at + 1, F.length(low))).otherwise("").alias("domain"))


@F.pandas_udf(T.StringType())
def strip_accents(names: pd.Series) -> pd.Series:
    """Canonical decomposition without combining marks; the four letters that do not decompose are spelled out."""
    spelled = str.maketrans({"ø": "o", "ß": "ss", "æ": "ae", "ð": "o"})
    return names.map(lambda s: None if s is None else re.sub("[̀-ͯ]", "", unicodedata.normalize("NFD", s)).translate(spelled))


def name_key(name: Column, email: Column) -> Column:
    """The name without accents; one word alone is told apart by its address. Plain ASCII stays out of Python."""
    ascii_only = ~name.rlike(r"[^\x00-\x7F]")
    plain = F.when(ascii_only, name).otherwise(strip_accents(F.when(~ascii_only, name)))
    return F.lower(F.when(F.instr(plain, " ") > 0, plain).otherwise(F.concat(plain, F.lit(" at "), email)))


def preferred_name(name: Column, email: Column) -> Column:
    return F.when(F.instr(name, " ") > 0, name).otherwise(email)


def full_email(name: Column, email: Column) -> Column:
    return F.concat(name, F.lit(" <"), email, F.lit(">"))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def language(path: Column) -> Column:
    pairs = [F.lit(x) for lang, exts in LANGUAGES.items() for e in exts for x in (e, lang)]
    return F.try_element_at(F.create_map(*pairs), extension(path))


def file_mask(languages=MASKED) -> str:
    exts = sorted(e for lang in languages for e in LANGUAGES[lang])
    return r"(?i)\.(" + "|".join(re.escape(e) for e in exts) + ")$"


def has_extension(path: Column, extensions: list[str]) -> Column:
    """Paths that end in one of the extensions with its dot, so .c is not .cc."""
    bad = [e for e in extensions if not re.fullmatch("[a-z0-9+]+", e)]
    if bad or not extensions:
        raise ValueError(f"not extensions: {bad}")
    out = F.lit(False)
    for e in sorted(extensions):
        out = out | F.lower(path).endswith(f".{e}")
    return out


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def sha1_hex(content: bytes) -> str:
    return hashlib.sha1(content).hexdigest()


def memo_path(content: Column) -> Column:
    sha = F.sha1(content)
    return F.concat_ws("/", F.substring(sha, 1, 2), F.substring(sha, 3, 2), sha)


def plain_text(text: str) -> str:
    """undo_mojibake of one string."""
    try:
        return text.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return text


def undo_mojibake(c: Column) -> Column:
    """Latin-1 bytes read as UTF-8; text that is neither stays."""
    fits = c.rlike(r"^[\x00-\xff]*$")
    return F.coalesce(F.when(fits, F.try_validate_utf8(F.encode(F.when(fits, c), "ISO-8859-1").cast("string"))), c)


def html_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def folded(c: Column) -> Column:
    return F.translate(c, "\n\r", "  ")


def saturating_sum(a: Column, b: Column) -> Column:
    return F.least(F.greatest(a.cast("long") + b.cast("long"), F.lit(0)), F.lit(2**31 - 1)).cast("int")


def saturating_product(a: Column, b: Column) -> Column:
    return F.least(F.greatest(a.cast("decimal(20,0)") * b.cast("decimal(18,0)"), F.lit(0)), F.lit(2**31 - 1)).cast("int")


def memory_size(text: str) -> str:
    """An absolute size such as 8GB or 512 MiB; shares of memory are refused."""
    if not re.fullmatch(r"\s*[0-9]+(\.[0-9]+)?\s*([KMGT]i?)?B?\s*", text, re.I):
        raise ValueError(f"not an absolute memory size: {text!r}")
    return text.strip()


def unquote_path(name: str) -> str:
    """A path as version control quotes it: C escapes and octal bytes between double quotes."""
    return unquote_bytes(name.encode()).decode("utf-8", "replace")


def unquote_bytes(name: bytes) -> bytes:
    if not (len(name) > 1 and name[:1] == name[-1:] == b'"'):
        return name
    single = dict(zip(b'abtnvfr"\\', b'\a\b\t\n\v\f\r"\\', strict=True))

    def one(m: re.Match) -> bytes:
        code = m[1]
        return bytes([int(code, 8) if len(code) == 3 else single[code[0]]])

    return re.sub(rb'\\([0-3][0-7]{2}|[abtnvfr"\\])', one, name[1:-1])


@F.pandas_udf(T.StringType())
def unquoted_path(names: pd.Series) -> pd.Series:
    return names.map(lambda s: None if s is None else unquote_path(s))
