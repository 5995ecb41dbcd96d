"""Lexers that turn sources into token lines, and the table function that runs each content once.

A lexer yields (line, column, kind, value), positions in code points from 1; line 0 marks a begin_ or end_ line. C, C++
and Java go through a light grammar that names the element of each token.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as fn
from . import grammar, mapping, walk

Token = tuple[int, int, str, str]

#: Bytes of contents whose results are held at once.
BATCH = 1 << 18

# Reserved words.
RUST = set("as async await break const continue crate dyn else enum extern false fn for if impl in let loop match mod move mut pub ref return self Self static struct super trait true type union unsafe use where while".split())
GO = set("break case chan const continue default defer else fallthrough for func go goto if import interface map package range return select struct switch type var".split())


class LexError(ValueError):
    pass


def _scan(text: str, rules: list[tuple[str, re.Pattern]], nested: bool = False) -> Iterator[Token]:
    """Tokens by the first rule that matches at each place; rules without a kind are skipped."""
    at, line, start = 0, 1, 0
    while at < len(text):
        kind, end = "unknown", at + 1
        if nested and text.startswith("/*", at):
            depth, end = 1, at + 2
            while depth and end < len(text):
                depth, step = (depth + 1, 2) if text.startswith("/*", end) else (depth - 1, 2) if text.startswith("*/", end) else (depth, 1)
                end += step
            kind = "comment" if not depth else "unknown"
        else:
            for name, rule in rules:
                if m := rule.match(text, at):
                    kind, end = name, m.end()
                    break
        value = text[at:end]
        if kind:
            yield line, at - start + 1, kind, value.replace("\n", " ").replace("\r", " ")
        if feeds := value.count("\n"):
            line, start = line + feeds, at + value.rindex("\n") + 1
        at = end


def _rules(*pairs: tuple[str, str]) -> list[tuple[str, re.Pattern]]:
    return [(k, re.compile(p, re.S)) for k, p in pairs]


_SPACE = ("", r"\s+")
_RUST = _rules(_SPACE, ("comment", r"//[^\n]*"), ("literal", r'[bc]?r(#*)".*?"\1'), ("literal", r'[bc]?"(?:\\.|[^"\\])*"'), ("literal", r"b?'(?:\\(?:u\{[0-9a-fA-F_]*\}|x[0-9a-fA-F]{2}|.)|[^'\\])'"), ("lifetime", r"'[^\W\d]\w*"), ("identifier", r"r#[^\W\d]\w*"), ("word", r"[^\W\d]\w*"), ("literal", r"\d[\w]*(?:\.\d[\w]*)?(?:[eE][+-]?\d+)?"), ("op", r"[!-/:-@\[-^`{-~]"))
_GO = _rules(_SPACE, ("COMMENT", r"//[^\n]*|/\*.*?\*/"), ("STRING", r'`[^`]*`|"(?:\\.|[^"\\\n])*"'), ("CHAR", r"'(?:\\.|[^'\\\n])+'"), ("FLOAT", r"\d+\.\d*(?:[eE][+-]?\d+)?|\d+[eE][+-]?\d+"), ("INT", r"0[xXbBoO][0-9a-fA-F_]+|\d[\d_]*"), ("word", r"[^\W\d]\w*"), ("op", r"<<=|>>=|&\^=|\.\.\.|<-|\+\+|--|&&|\|\||:=|&\^|[-+*/%&|^=!<>]=|<<|>>|[!-/:-@\[-^`{-~]"))
_M4 = _rules(_SPACE, ("comment", r"#[^\n]*|dnl\b[^\n]*"), ("identifier", r"[A-Za-z_]\w*"))


def rust(text: str) -> Iterator[Token]:
    for line, col, kind, value in _scan(text, _RUST, nested=True):
        yield line, col, ("keyword" if value in RUST else "identifier") if kind == "word" else kind, value


def _family(language: str) -> Callable[[str], Iterator[Token]]:
    return lambda text: grammar.elements(text, language)


# Tokens behind which the end of a line is a semicolon.
_GO_ENDS = {"IDENT", "INT", "FLOAT", "IMAG", "CHAR", "STRING", "break", "continue", "fallthrough", "return", "++", "--", ")", "]", "}"}


def go(text: str) -> Iterator[Token]:
    """Tokens with the semicolons that line ends and the end of the text stand for."""
    last, at = "", (1, 1)
    for line, col, kind, value in _scan(text, _GO):
        kind = (value if value in GO else "IDENT") if kind == "word" else value if kind == "op" else kind
        if line > at[0] and last in _GO_ENDS:
            yield *at, ";", "\n"
            last = ""
        yield line, col, kind, value
        if kind == "COMMENT":
            if not value.startswith("/*") or last not in _GO_ENDS:
                continue
            at = (line, at[1])  # a block comment on one line changes nothing
        else:
            last, at = kind, (line, col + len(value))
    if last in _GO_ENDS:
        yield *at, ";", "\n"


class _Lines:
    """Lines and columns of rising places in a text."""

    def __init__(self, text: str) -> None:
        self.text, self.seen, self.line, self.start = text, 0, 1, 0

    def __call__(self, at: int) -> tuple[int, int]:
        if feeds := self.text.count("\n", self.seen, at):
            self.line, self.start = self.line + feeds, self.text.rindex("\n", self.seen, at) + 1
        self.seen = at
        return self.line, at - self.start + 1


def m4(text: str) -> Iterator[Token]:
    """Quotes `...' nest and are stripped; an open one is an error."""
    at, place = 0, _Lines(text)
    out: list[Token] = []
    while at < len(text):
        line, col = place(at)
        if text[at] in "`[":
            open_, close = text[at], {"`": "'", "[": "]"}[text[at]]
            depth, end = 1, at + 1
            while depth:
                if end >= len(text):
                    raise LexError("a string has no end")
                depth += (text[end] == open_) - (text[end] == close)
                end += 1
            out.append((line, col, "string", text[at + 1 : end - 1].replace("\n", " ")))
            at = end
            continue
        for kind, rule in _M4:
            if m := rule.match(text, at):
                if kind:
                    out.append((line, col, kind, m[0]))
                at = m.end()
                break
        else:
            out.append((line, col, "token", text[at]))
            at += 1
    return iter(out)


def plain(text: str) -> Iterator[Token]:
    place = _Lines(text)
    for m in re.finditer(walk.TOKENS, text):
        yield *place(m.start()), "text", m[0]


LEXERS: dict[str, Callable[[str], Iterator[Token]]] = {"Rust": rust, "C": _family("C"), "C++": _family("C++"), "Java": _family("Java"), "M4": m4, "Go": go, "text": plain}

_DECLARED = {"Rust": [("function", r"\bfn\s+(\w+)"), ("struct", r"\bstruct\s+(\w+)"), ("enum", r"\benum\s+(\w+)"), ("trait", r"\btrait\s+(\w+)")]}


def declarations(text: str, language: str) -> list[tuple[int, str, str]]:
    """(line, kind, name) of declarations; functions of the C family and Java with their signatures."""
    if language in ("C", "C++", "Java"):
        return grammar.declared(text, language)
    place = _Lines(text)
    found = []
    for m, kind in sorted(((m, kind) for kind, p in _DECLARED.get(language, ()) for m in re.finditer(p, text)), key=lambda x: x[0].start(1)):
        found.append((place(m.start(1))[0], kind, m[1]))
    return found


def token_lines(text: str, language: str, position: bool = False) -> list[str]:
    """Lines `type|value` between unit markers. A line's declarations stand before the first token of each run of
    tokens of that line, which a marker ends too; a blank line follows an end marker."""
    if language not in LEXERS:
        raise LexError(f"no lexer for {language}")
    put = (lambda where, s: f"{where}|{s}") if position else (lambda _, s: s)
    named: dict[int, list] = {}
    for line, kind, name in declarations(text, language):
        named.setdefault(line, []).append((kind, name))
    out, last = [put("-:-", f"begin_unit|language:{language}")], 0
    for line, col, kind, value in LEXERS[language](text):
        if not line:
            out.append(put("-:-", kind))
            if kind.startswith("end_"):
                out.append("")
        else:
            if line != last:
                out += [put(f"{line}:-", f"DECL|{k}|{n}") for k, n in named.get(line, ())]
            out.append(put(f"{line}:{col}", f"{kind}|{value}"))
        last = line
    return [*out, put("-:-", "end_unit"), ""]


def _results(rows: DataFrame, one: Callable[[str, str, bytes], tuple[str, list[str] | None]]) -> DataFrame:
    """(content_sha, ext, status, tokens) of (content_sha, ext, content) rows by one(language, ext, content)."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            n = 0
            while n < b.num_rows:
                # a batch of results has no more than BATCH bytes of contents, or one content that is larger
                first, size, found = n, 0, []
                while n < b.num_rows and (not found or size + len(b.column(2)[n].as_buffer() or b"") <= BATCH):
                    ext, content, language = (b.column(i)[n].as_py() for i in (1, 2, 3))
                    found.append(one(language, ext, content or b""))
                    size += len(content or b"")
                    n += 1
                keys = b.slice(first, n - first)
                yield pa.RecordBatch.from_arrays([keys.column(0), keys.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(pa.string()))], names=["content_sha", "ext", "status", "tokens"])
                del found

    language = fn.language(F.concat(F.lit("x."), F.col("ext")))
    return rows.select("content_sha", "ext", "content", language.alias("language")).filter("language IS NOT NULL").mapInArrow(run, "content_sha string, ext string, status string, tokens array<string>")


def source_text(content: bytes) -> str:
    """walk.decoded of one content."""
    return content.decode("utf-8", "replace").removeprefix("\ufeff").replace("\r\n", "\n").replace("\r", "\n")


def lexed(rows: DataFrame) -> DataFrame:
    """(content_sha, ext, status, tokens) of (content_sha, ext, content) rows; without a lexer a row is left out.
    status: ok; tokenizer-error where a lexer refuses; parser-crash where it breaks, or gives nothing for something."""

    def one(language: str, ext: str, content: bytes) -> tuple[str, list[str] | None]:
        text = source_text(content)
        try:
            lines = token_lines(text, language)
        except LexError:
            return "tokenizer-error", None
        except Exception:  # noqa: BLE001  whatever one file does to a lexer, the others go on
            return "parser-crash", None
        return ("parser-crash", None) if text.strip() and len(lines) < 4 else ("ok", lines)

    return _results(rows, one)


def by_command(command: list[str], seconds: float = 600.0) -> Callable[[DataFrame], DataFrame]:
    """A tokenizer of (content_sha, ext, content) rows by a command of one's own: content on its input, token lines on its
    output, the names in BFG_BLOB, BFG_FILENAME and BFG_PATH. It has so many seconds for a content; what its end means
    is mapping's rule, and output that equals the input leaves the blob as it is (skip)."""
    from . import commands

    def tokenize(rows: DataFrame) -> DataFrame:
        def one(language: str, ext: str, content: bytes) -> tuple[str, list[str] | None]:
            name = f"content.{ext}"
            done = commands.run(command, content, seconds, {"BFG_BLOB": fn.sha1_hex(content), "BFG_FILENAME": name, "BFG_PATH": name})
            status = mapping.outcome_of(done.killed, done.status, done.out, content)
            if status == "skip":
                return "skip", None
            return ("ok", done.out.decode("utf-8", "replace").removesuffix("\n").split("\n")) if status == "replace" else (status, None)

        return _results(rows, one)

    return tokenize


def by_worker(command: list[str], seconds: int = 600) -> Callable[[DataFrame], DataFrame]:
    """The same through a worker that stays alive, one a task (commands.Worker)."""
    from . import commands

    def tokenize(rows: DataFrame) -> DataFrame:
        held: dict[str, commands.Worker] = {}

        def one(language: str, ext: str, content: bytes) -> tuple[str, list[str] | None]:
            worker = held.setdefault("worker", commands.Worker(command))
            done = worker.ask(f"content.{ext}", content, seconds)
            status = mapping.outcome_of(done.killed, done.status, done.out, content)
            if status == "skip":
                return "skip", None
            return ("ok", done.out.decode("utf-8", "replace").removesuffix("\n").split("\n")) if status == "replace" else (status, None)

        return _results(rows, one)

    return tokenize


def tokenized(files: DataFrame, memo: DataFrame | None = None, tokenize: Callable[[DataFrame], DataFrame] = lexed) -> DataFrame:
    """(content_sha, ext, status, tokens) of (path, content binary): each content goes once through its lexer, those in
    memo (content_sha, ext) not at all. status is ok, tokenizer-error or parser-crash; without a lexer a file is left out."""
    rows = files.select(F.sha1("content").alias("content_sha"), fn.extension(F.col("path")).alias("ext"), "content")
    rows = rows.filter(fn.language(F.col("path")).isNotNull()) if "path" in rows.columns else rows.filter(fn.language(F.concat(F.lit("x."), F.col("ext"))).isNotNull())
    rows = rows.dropDuplicates(["content_sha", "ext"])
    if memo is not None:
        rows = rows.join(memo.select("content_sha", "ext"), ["content_sha", "ext"], "left_anti")
    return tokenize(rows)


def attribute(revisions: list[tuple[str, list[str]]]) -> list[tuple[str, str]]:
    """(commit, line) of the last revision's lines: each belongs to the first revision from which it came down
    unchanged. Revisions go from oldest to newest."""
    from difflib import SequenceMatcher

    owners: list[str] = []
    lines: list[str] = []
    for commit, new in revisions:
        kept: list[str] = []
        for tag, a, b, c, d in SequenceMatcher(None, lines, new, autojunk=False).get_opcodes():
            kept += owners[a:b] if tag == "equal" else [commit] * (d - c)
        owners, lines = kept, new
    return list(zip(owners, lines, strict=True))


def native_blame(revisions: DataFrame) -> DataFrame:
    """(file_path, line_no, commit_sha, token) from (file_path, seq, commit_sha, tokens): a file's history in one task."""

    def by_file(pdf):
        import pandas as pd

        pdf = pdf.sort_values("seq")
        found = attribute([(c, list(t)) for c, t in zip(pdf["commit_sha"], pdf["tokens"], strict=True)])
        return pd.DataFrame({"file_path": pdf["file_path"].iloc[0], "line_no": range(len(found)), "commit_sha": [c for c, _ in found], "token": [t for _, t in found]})

    return revisions.groupBy("file_path").applyInPandas(by_file, "file_path string, line_no int, commit_sha string, token string")
