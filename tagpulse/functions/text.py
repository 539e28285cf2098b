"""HTML to plain text."""

from __future__ import annotations

from functools import cache
from html.entities import html5, name2codepoint

# Fixed values. One alternation, so that the leftmost construct wins, as it does in a tokenizer: a
# script inside a comment is comment, a comment inside a script is script. Quoted attribute
# values may hold ">". Their repeat is possessive, which Java runs as a loop; a quote that is
# never closed ends the attributes, and a tag that is never closed ends at its next ">".
_QUOTED_ATTRIBUTE = r"[^>\x22\x27]*=\s*(?:\x22[^\x22]*\x22|\x27[^\x27]*\x27)"
_ATTRIBUTES = r"(?:" + _QUOTED_ATTRIBUTE + r")*+[^>]*"
# Templates nest, which no pattern can follow, so their tags are left for a second step.
MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|script(?:[\s/][^>]*)?>.*?(?:</script[^>]*>|\z)"
    r"|style(?:[\s/][^>]*)?>.*?(?:</style[^>]*>|\z)"
    r"|(?!/?template[\s/>])[a-z!?/](?:" + _ATTRIBUTES + r">|[^>]*>))"
)
TEMPLATE_START = r"(?i)(?=</?template[\s/>])"
TEMPLATE_TAG = r"(?is)^</?template(?:[\s/](?:" + _ATTRIBUTES + r">|[^>]*>)|>)"
LEFTOVER_TAG = r"<[^>]+>"
# White space as Unicode text processing sees it, the no-break space and the four
# information separators included. A class listing the ranges means the same and is four
# times as slow, since every character of the text is held against every range.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*)"

_PAIR, _ENTRY = "\x02", "\x01"
_COMMON = ("amp", "lt", "gt", "quot", "nbsp", "apos")


def raw(pattern: str) -> str:
    """A pattern as a raw SQL literal (raw literals cannot hold a quote)."""
    return f"r'{pattern}'"


def _map(table: dict[str, str]) -> str:
    """SQL for a map of strings, folded to a constant by Catalyst."""
    text = _ENTRY.join(f"{name}{_PAIR}{chars}" for name, chars in table.items())
    text = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"str_to_map('{text}', '{_ENTRY}', '{_PAIR}')"


@cache
def _named_characters() -> str:
    """Names of the HTML standard, from the Python library, to characters.

    Common names come first, as a map lookup is a scan.
    """
    names = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
    order = dict.fromkeys([*_COMMON, *name2codepoint, *sorted(names)])
    return _map({name: names[name] for name in order})


@cache
def _windows_characters() -> str:
    """Numbers 128-159, which mean Windows-1252 characters."""
    decoded = {code: bytes([code]).decode("cp1252", errors="ignore") for code in range(128, 160)}
    return _map({str(code): char or chr(code) for code, char in decoded.items()})


def _numeric_entity(name: str) -> str:
    # Without leading zeros, seven decimal or six hexadecimal digits hold every character.
    digits = f"CASE WHEN {name} RLIKE '^#[xX]' THEN ltrim('0', substr({name}, 3)) ELSE ltrim('0', substr({name}, 2)) END"
    code = (
        f"CASE WHEN length({digits}) > 7 THEN 0 "
        f"WHEN {name} RLIKE '^#[xX]' THEN CAST(conv({digits}, 16, 10) AS BIGINT) "
        f"ELSE CAST(nullif({digits}, '') AS BIGINT) END"
    )
    return (
        f"CASE WHEN {code} BETWEEN 128 AND 159 THEN {_windows_characters()}[CAST({code} AS STRING)] "
        f"WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 "
        f"THEN decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') "
        f"ELSE '�' END"
    )


def drop_templates(text: str) -> str:
    """The text outside all templates. A closing tag without a template is dropped, and a
    template that is never closed reaches to the end."""
    step = (
        f"CASE WHEN NOT piece RLIKE {raw(TEMPLATE_TAG)} THEN named_struct('depth', done.depth, 'kept', "
        "IF(done.depth = 0, concat(done.kept, array(piece)), done.kept)) "
        "WHEN piece LIKE '</%' THEN named_struct('depth', greatest(done.depth - 1, 0), 'kept', "
        f"IF(done.depth <= 1, concat(done.kept, array(regexp_replace(piece, {raw(TEMPLATE_TAG)}, ''))), done.kept)) "
        "ELSE named_struct('depth', done.depth + 1, 'kept', done.kept) END"
    )
    outside = (
        f"aggregate(split({text}, {raw(TEMPLATE_START)}, -1), "
        "named_struct('depth', 0, 'kept', CAST(array() AS ARRAY<STRING>)), "
        f"(done, piece) -> {step}, done -> array_join(done.kept, ' '))"
    )
    return f"CASE WHEN {text} RLIKE {raw(TEMPLATE_START)} THEN {outside} ELSE {text} END"


def decode_entities(text: str) -> str:
    """Decode named and numeric character references in one pass, each once.

    The text is cut at every "&", so no decoded character is read again (``&amp;lt;`` is
    ``&lt;``). An unknown name stays, without its semicolon.
    """
    name = f"regexp_extract(p, {raw(REFERENCE)}, 1)"
    decoded = (
        f"CASE WHEN {name} LIKE '#%' THEN {_numeric_entity(name)} "
        f"ELSE coalesce({_named_characters()}[{name}], concat('&', {name})) END"
    )
    piece = (
        f"CASE WHEN i = 0 THEN p WHEN p RLIKE {raw(REFERENCE)} "
        f"THEN concat({decoded}, regexp_replace(p, {raw(REFERENCE + ';?')}, '')) ELSE concat('&', p) END"
    )
    return f"array_join(transform(split({text}, '&', -1), (p, i) -> {piece}), '')"


def strip_html(text: str, restrip: bool = True) -> str:
    """Inner text of an HTML fragment: pieces joined by one space, blanks collapsed.

    ``restrip`` deletes tag-like text once more *after* entities are decoded, so quoted
    code such as ``List&lt;String&gt;`` loses its ``<String>``; False keeps it.
    Null gives the empty string.
    """
    untagged = f"regexp_replace(coalesce({text}, ''), {raw(MARKUP)}, ' ')"
    # Bound once in a one-element array, as the text is used three times.
    out = decode_entities(f"transform(array({untagged}), t -> {drop_templates('t')})[0]")
    if restrip:
        out = f"regexp_replace({out}, {raw(LEFTOVER_TAG)}, '')"
    return f"trim(regexp_replace({out}, {raw(BLANKS)}, ' '))"
