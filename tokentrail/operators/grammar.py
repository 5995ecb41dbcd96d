"""A light grammar of C, C++ and Java: every token gets the name of the element that it stands in.

Top-level elements (functions, declaration statements, classes, directives, comments, ...) are framed by begin_ and end_
markers. Within them names, literals, operators, argument and parameter lists, conditions, blocks and statements are
told apart by what stands around a token. It is a scan with a stack and no full parser: macros are not expanded, and
where the grammar needs types to decide (a cast or a call, a product or a declaration) the more usual reading is taken.
Every character of the source that is not white space is in exactly one token, whatever the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

Token = tuple[int, int, str, str]

# Words by what they do in C, C++ and Java.
SPECIFIERS = set("static const volatile inline register auto restrict constexpr virtual explicit friend mutable typename public private protected final abstract synchronized native transient strictfp default noexcept override".split())
BASIC = set("void char short int long float double signed unsigned bool boolean byte wchar_t size_t".split())
TAGGED = {"struct": "struct", "class": "class", "union": "union", "enum": "enum", "interface": "interface"}
FIRST = {"typedef": "typedef", "namespace": "namespace", "using": "using", "extern": "extern", "package": "package", "import": "import"}
STATEMENTS = set("if else while for do switch case default break continue return goto try catch throw finally assert".split())
LITERAL_WORDS = set("true false null nullptr NULL this super".split()) - {"this", "super", "NULL"}

_TOKEN = re.compile(
    r"(?P<space>\s+|\\\r?\n)|(?P<comment>//[^\n]*|/\*.*?(?:\*/|\Z))"
    r'|(?P<literal>"""(?:\\.|.)*?"""|(?:u8|[LuU])?"(?:\\.|[^"\\\n])*"|[LuU]?\'(?:\\.|[^\'\\\n])+\'|(?:0[xX][0-9a-fA-F\']+|\d[\d\']*\.?[\d\']*(?:[eE][+-]?\d+)?|\.\d+)\w*)'
    r"|(?P<word>[^\W\d]\w*)|(?P<op><<=|>>=|\.\.\.|->\*?|\+\+|--|&&|\|\||::|[-+*/%&|^=!<>]=|<<|>>|.)",
    re.S,
)


class _Lexemes:
    """The lexemes of a text with their places; directives, up to their line's end, are cut out whole."""

    def __init__(self, text: str, directives: bool) -> None:
        self.items: list[tuple[int, int, str, str, int]] = []
        at, line, start, fresh = 0, 1, 0, True
        while at < len(text):
            if directives and fresh and (m := re.compile(r"#(?:[^\n\\/]|\\.|/(?![/*])|/\*.*?\*/)*", re.S).match(text, at)):
                kind, end = "directive", m.end()
            else:
                m = _TOKEN.match(text, at)
                kind, end = m.lastgroup, m.end()
            value = text[at:end]
            if kind != "space":
                self.items.append((line, at - start + 1, kind, value.rstrip() if kind == "directive" else value, at))
                fresh = False
            if feeds := value.count("\n"):
                line, start = line + feeds, at + value.rindex("\n") + 1
                fresh = fresh or kind == "space"
            at = end


def _directive(line: int, col: int, value: str) -> tuple[str, list[Token]]:
    """The element's name and the tokens of a directive."""
    m = re.match(r"#\s*([^\W\d]\w*)?", value)
    word = m[1] or ""
    tag = word if word in ("include", "define", "undef", "ifdef", "ifndef", "if", "elif", "else", "endif", "error", "warning", "pragma", "line", "import") else "directive"
    out: list[Token] = [(line, col, tag, "#")]

    def put(kind: str, at: int, end: int) -> None:
        before = value[:at]
        row = line + before.count("\n")
        out.append((row, (col if row == line else 0) + at - (before.rfind("\n") + 1 if "\n" in before else 0) + (row != line), kind, value[at:end]))

    if word:
        put("directive", m.start(1), m.end(1))
    rest = m.end()
    if tag in ("include", "import") and (f := re.compile(r'\s*(<[^>]*>|"[^"]*")').match(value, rest)):
        put("file", f.start(1), f.end(1))
        rest = f.end()
    if tag == "define" and (f := re.compile(r"\s*([^\W\d]\w*)(\([^)]*\))?").match(value, rest)):
        put("name", f.start(1), f.end(1))
        if f[2]:
            put("parameter_list", f.start(2), f.end(2))
        rest = f.end()
        if body := value[rest:].strip():
            begin = value.index(body, rest)
            put("value", begin, begin + len(body))
        return tag, out
    for t in _TOKEN.finditer(value, rest):
        kind = t.lastgroup
        if kind != "space":
            put({"word": "name", "op": "operator"}.get(kind, kind), t.start(), t.end())
    return tag, out


def _match(items: list, at: int, open_: str, close: str) -> int:
    """The place of the closing mark, or the last item."""
    depth = 0
    for k in range(at, len(items)):
        value = items[k][3] if items[k][2] == "op" else ""
        depth += (value == open_) - (value == close)
        if not depth:
            return k
    return len(items) - 1


def _extent(items: list, at: int) -> int:
    """The last item of the declaration or definition that begins at an item."""
    k, tagged = at, False
    while k < len(items):
        _, _, kind, value, _ = items[k]
        if kind == "directive":
            return max(at, k - 1)
        if kind == "word" and value in TAGGED or value == "=":
            tagged = True
        if kind == "op" and value in "([":
            k = _match(items, k, value, ")" if value == "(" else "]")
        elif kind == "op" and value == "{":
            k = _match(items, k, "{", "}")
            following = items[k + 1][3] if k + 1 < len(items) else ""
            if not tagged or following not in (";", ",") and not (k + 1 < len(items) and items[k + 1][2] == "word" and tagged and _ends_soon(items, k + 1)):
                return k + 1 if following == ";" else k
        elif kind == "op" and value in ";}":
            return k
        k += 1
    return len(items) - 1


def _ends_soon(items: list, at: int) -> bool:
    """Whether names and marks of declarators lead to a semicolon on the same line."""
    for k in range(at, min(at + 8, len(items))):
        if items[k][3] == ";":
            return items[k][0] == items[at][0]
        if items[k][2] != "word" and items[k][3] not in "*,[]" or items[k][0] != items[at][0]:
            return False
    return False


def _kind_of(part: list, language: str) -> str:
    """The name of a top-level element."""
    words = [(k, v) for _, _, k, v, _ in part]
    at = 0
    if words[0][1] == "template" and len(words) > 1 and words[1][1] == "<":
        at = _match(part, 1, "<", ">") + 1
    while at < len(words) and (words[at][1] in SPECIFIERS or words[at][1] == "@"):
        at += 2 if words[at][1] == "@" else 1
    if at >= len(words):
        return "decl_stmt"
    first = words[at][1]
    if first == ";":
        return "empty_stmt"
    if first == "extern" and at + 1 < len(words) and words[at + 1][0] != "literal":
        pass
    elif first in FIRST:
        return FIRST[first]
    opened = next((k for k, w in enumerate(words) if w[1] == "{"), None)
    called = next((k for k, w in enumerate(words) if w[1] == "("), None)
    equals = next((k for k, w in enumerate(words) if w[1] == "="), None)
    if first in TAGGED:
        if opened is not None and (called is None or opened < called) and (equals is None or opened < equals):
            return TAGGED[first]
        if len(words) - at <= 3 and words[-1][1] == ";" and called is None:
            return f"{TAGGED[first]}_decl"
    if called is not None and called and words[called - 1][0] == "word" and (equals is None or called < equals):
        if opened is not None and opened > called:
            return "function"
        if words[-1][1] == ";":
            return "function_decl" if called > at + 1 or language != "C" else "macro"
        return "macro"
    return "decl_stmt"


class _Typer:
    """Element names of the tokens of one top-level element, by a stack of what is open."""

    def __init__(self, part: list, kind: str) -> None:
        self.part, self.kind = part, kind
        self.stack: list[str] = []  # what each open bracket is
        self.statement, self.fresh, self.declares, self.parts = kind, True, kind not in ("expr_stmt",), 0

    def _declaration_at(self, k: int) -> bool:
        """Whether a statement begins here that declares: a type, marks, and a name."""
        part, n = self.part, 0
        if part[k][3] in TAGGED or part[k][3] in SPECIFIERS or part[k][3] in BASIC:
            return True
        while k < len(part) and n < 12:
            kind, value = part[k][2], part[k][3]
            if kind == "word":
                following = part[k + 1] if k + 1 < len(part) else None
                if following is None or value in STATEMENTS:
                    return False
                if following[2] == "word":
                    return following[3] not in STATEMENTS
                if following[3] in ("::", "."):
                    k += 2
                elif following[3] == "<":
                    end = _match(part, k + 1, "<", ">")
                    k, n = end, n + 1
                    if end - k > 8 or k + 1 >= len(part) or part[k + 1][2] != "word":
                        return False
                    return True
                elif following[3] in ("*", "&"):
                    j = k + 1
                    while j < len(part) and part[j][3] in ("*", "&", "const"):
                        j += 1
                    return j + 1 < len(part) and part[j][2] == "word" and part[j + 1][3] in ("=", ";", ",", "[", ")")
                elif following[3] == "[" and k + 3 < len(part) and part[k + 2][3] == "]" and part[k + 3][2] == "word":
                    return True
                else:
                    return False
            else:
                return False
            n += 1
        return False

    def types(self) -> Iterator[str]:
        part = self.part
        for k, (_, _, kind, value, _) in enumerate(part):
            inner = self.stack[-1] if self.stack else ""
            before = part[k - 1] if k else None
            if kind in ("comment", "literal", "directive"):
                yield kind
                continue
            if self.fresh and inner in ("", "block"):
                if inner == "block":
                    self.declares = kind == "word" and value not in STATEMENTS and self._declaration_at(k)
                    self.statement = value if value in STATEMENTS else "decl_stmt" if self.declares else "expr_stmt"
                self.fresh = False
            if kind == "word":
                if inner in ("", "block") and value in STATEMENTS:
                    self.statement, self.declares = value, False
                    if value in ("else", "do", "try", "finally"):
                        self.fresh = True
                    yield value
                elif value == "sizeof":
                    yield "sizeof"
                elif value in LITERAL_WORDS:
                    yield "literal"
                elif value in SPECIFIERS or value == "extern":
                    yield "specifier"
                elif value in ("new", "delete", "instanceof"):
                    yield "operator"
                elif value in FIRST or value in ("throws", "extends", "implements", "template", "operator"):
                    yield value if value in FIRST and not inner else "name"
                elif value in TAGGED and not inner and self.kind == TAGGED[value]:
                    yield TAGGED[value]
                else:
                    yield "name"
                continue
            yield self._mark(k, value, inner, before)

    def _mark(self, k: int, value: str, inner: str, before) -> str:
        called = before is not None and (before[2] == "word" and before[3] not in STATEMENTS or before[3] in (")", "]", ">"))
        if value == "(":
            if self.statement in ("if", "while", "switch", "catch") and before[3] == self.statement:
                opens = "condition"
            elif self.statement == "for" and before[3] == "for":
                opens, self.parts = "control", 0
            elif called and not self.stack and self.kind in ("function", "function_decl", "macro"):
                opens = "parameter_list"
            elif called or before is not None and before[3] == "sizeof":
                opens = "argument_list"
            else:
                opens = "operator"
            self.stack.append(opens)
            return opens
        if value in ")]}":
            closed = self.stack.pop() if self.stack else "operator"
            if value == "}" or closed == "condition" or closed == "control":
                self.fresh = not self.stack or self.stack[-1] == "block"
            return closed
        if value == "[":
            self.stack.append("index")
            return "index"
        if value == "{":
            data = before is not None and before[3] in ("=", ",", "(", "{", "return") and (before[3] != "{" or inner == "expr")
            self.stack.append("expr" if data or inner in ("expr", "argument_list") else "block")
            self.fresh = self.stack[-1] == "block"
            return "block"
        if value == ";":
            if inner == "control":
                self.parts += 1
                return "init" if self.parts == 1 else "condition"
            self.fresh = True
            own = self.statement if inner else self.kind
            return own if own in STATEMENTS or own.endswith("_stmt") or not inner else "expr_stmt"
        if value == ",":
            if inner in ("argument_list", "parameter_list"):
                return inner
            return "decl_stmt" if self.declares and inner in ("", "block") else "operator"
        if value == ":" and self.statement in ("case", "default") and inner == "block":
            self.fresh = True
            return self.statement
        if value in ("*", "&", "&&") and (self.declares and inner in ("", "block", "parameter_list") or inner == "parameter_list"):
            return "modifier"
        if value == "=" and self.declares and inner in ("", "block", "parameter_list"):
            return "init"
        return "operator"


def elements(text: str, language: str) -> Iterator[Token]:
    """(line, column, type, value) of a text's tokens, with (0, 0, begin_... or end_..., "") around top-level elements.
    An empty pair of brackets is one token; line ends within a token are spaces."""
    items = _Lexemes(text, language in ("C", "C++")).items
    flat = lambda v: v.replace("\n", " ").replace("\r", " ")
    at = 0
    while at < len(items):
        line, col, kind, value, _ = items[at]
        if kind == "comment":
            tag, tokens, end = "comment", [(line, col, "comment", flat(value))], at
        elif kind == "directive":
            tag, tokens = _directive(line, col, value)
            tokens, end = [(a, b, c, flat(v)) for a, b, c, v in tokens], at
        else:
            end = max(at, _extent(items, at))
            part = items[at : end + 1]
            tag, tokens = _kind_of(part, language), []
            typer = _Typer(part, tag)
            skip = False
            for k, ((a, b, what, v, place), t) in enumerate(zip(part, typer.types(), strict=True)):
                if skip:
                    skip = False
                    continue
                if what == "directive":
                    tokens += [(x, y, z, flat(w)) for x, y, z, w in _directive(a, b, v)[1]]
                    continue
                if v in ("(", "[", "{") and k + 1 < len(part) and part[k + 1][3] == {"(": ")", "[": "]", "{": "}"}[v] and part[k + 1][4] == place + 1:
                    v, skip = v + part[k + 1][3], True
                tokens.append((a, b, t, flat(v)))
        yield 0, 0, f"begin_{tag}", ""
        yield from tokens
        yield 0, 0, f"end_{tag}", ""
        at = end + 1


def declared(text: str, language: str) -> list[tuple[int, str, str]]:
    """(line, kind, name) of top-level declarations and, in classes, of methods; a function's name has its signature."""
    items = _Lexemes(text, language in ("C", "C++")).items
    out: list[tuple[int, str, str]] = []

    def walk(at: int, stop: int, inside: bool) -> None:
        while at < stop:
            line, _, kind, value, _ = items[at]
            if kind == "directive":
                if m := re.match(r"#\s*define\s+([^\W\d]\w*)", value):
                    out.append((line, "macro", m[1]))
                at += 1
                continue
            if kind == "comment" or value in ("}", ";"):
                at += 1
                continue
            end = min(_extent(items, at), stop - 1)
            part = [x for x in items[at : end + 1] if x[2] not in ("comment", "directive")]
            if part:
                one(part, _kind_of(part, language), inside)
            body = next((k for k in range(at, end + 1) if items[k][3] == "{" and items[k][2] == "op"), None)
            if body is not None and part and _kind_of(part, language) in ("class", "struct", "interface", "namespace", "extern", "enum") and language != "C":
                walk(body + 1, min(_match(items, body, "{", "}"), end + 1), True)
            at = max(end, at) + 1

    def one(part: list, kind: str, inside: bool) -> None:
        if kind in ("function", "function_decl"):
            called = next(k for k, x in enumerate(part) if x[3] == "(")
            close = _match(part, called, "(", ")")
            name = part[called - 1]
            plain = " ".join(x[3] for x in part[called + 1 : close])
            signature = re.sub(r" ?([,\[\]]) ?", r"\1", plain)
            out.append((name[0], "method" if inside else "prototype" if kind == "function_decl" else "function", f"{name[3]} ({signature})"))
        elif kind.removesuffix("_decl") in TAGGED.values():
            at = next((k for k, x in enumerate(part) if x[3] in TAGGED), 0)
            if not kind.endswith("_decl") and at + 1 < len(part) and part[at + 1][2] == "word":
                out.append((part[at + 1][0], kind, part[at + 1][3]))
        elif kind in ("decl_stmt", "typedef"):
            depth, name = 0, None
            for x in part:
                if x[3] in "([{" and x[2] == "op":
                    depth += 1
                elif x[3] in ")]}" and x[2] == "op":
                    depth -= 1
                elif x[2] == "word" and not depth and x[3] not in SPECIFIERS:
                    name = x if name is None or name[1:] != x[1:] else name
                elif x[3] in ("=", ",", ";") and not depth:
                    if name is not None and name is not part[0]:
                        out.append((name[0], "typedef" if kind == "typedef" else "field" if inside else "variable", name[3]))
                    name = None
                    if x[3] == "=":
                        return

    walk(0, len(items), False)
    return sorted(out, key=lambda x: x[0])


def symbols(text: str, language: str) -> list[str]:
    """Functions and variables as `kind;name;type;signature` lines; the type is left empty where it is not told."""
    out = []
    for _, kind, name in declared(text, language):
        if kind in ("function", "method", "prototype"):
            plain, _, signature = name.partition(" ")
            out.append(f"function;{plain};;{signature}")
        elif kind in ("variable", "field"):
            out.append(f"variable;{name};;")
    return out
