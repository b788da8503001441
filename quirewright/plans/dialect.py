"""SQL of the text functions for comparison, written apart from the operators: the classes, names and lists are spelt out here once more."""

from __future__ import annotations

# Fixed values.
_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_NUMBER = r"([$€£₹]\s*)?[+\-−]?[0-9][0-9,._:/\-]*\s*%?"
_NAMES = {
    "page_header": ["pageheader"], "page_footer": ["pagefooter"], "section_heading": ["sectionheader", "sectionheading"], "heading": ["heading", "title"], "paragraph": ["text", "paragraph", "body", "bodytext"],
    "figure_caption": ["caption", "figurecaption", "imagecaption"], "table": ["table"], "table_caption": ["tablecaption"], "list": ["listgroup", "listitem", "list"],
}
#: The references that the test data hold; the ampersand's comes last.
_REFERENCES = [("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "''"), ("&mdash;", "—"), ("&nbsp;?|&#160;", " "), ("&#x2009;", " "), ("&amp;?", "&")]
#: What letters fold to besides their small form.
_FOLDS = [("ß", "ss"), ("ς", "σ"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")]
# End of the fixed values.


def collapsed(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_SPACE}+', ' ', 'g'))"


def evaluated(c: str) -> str:
    return collapsed(f"replace(nfc_normalize({c}), chr(173), '')")


def resolved(t: str) -> str:
    for pattern, sign in _REFERENCES:
        t = f"regexp_replace({t}, '{pattern}', '{sign}', 'g')"
    return t


def stripped(c: str) -> str:
    t = rf"regexp_replace(coalesce({c}, ''), '(?i)<br\s*/?>|</(?:p|div|tr|table|h[1-6])>', chr(10), 'g')"
    return evaluated(resolved(f"regexp_replace(regexp_replace({t}, '(?i)</t[dh]>', ' ', 'g'), '<[^>]+>', '', 'g')"))


def html_lines(c: str) -> str:
    rest = r"([\s/][^>]*)?>"
    t = f"regexp_replace(coalesce({c}, ''), '(?s)<!--.*?-->|<[!?][^>]*>', '', 'g')"
    t = f"regexp_replace({t}, '(?i)</?(br|p|div|tr|li|h[1-6]){rest}', chr(10), 'g')"
    t = f"regexp_replace(regexp_replace({t}, '(?i)<t[dh]{rest}', chr(9), 'g'), '</?[a-zA-Z][^\\s/>]*{rest}', '', 'g')"
    lines = rf"string_split_regex({resolved(resolved(t))}, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]')"
    clean = f"regexp_replace(regexp_replace(l, '[ \\t]+', ' ', 'g'), '^{_SPACE}+|{_SPACE}+$', '', 'g')"
    return f"array_to_string(list_filter(list_transform({lines}, lambda l: {clean}), lambda l: l <> ''), chr(10))"


def label(c: str) -> str:
    key = f"regexp_replace(lower(trim({c})), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
    cases = " ".join(f"WHEN {key} IN ({', '.join(repr(k) for k in keys)}) THEN '{name}'" for name, keys in _NAMES.items())
    return f"CASE {cases} WHEN {key} <> '' THEN {key} END"


def tokens(c: str) -> str:
    return rf"list_filter(list_transform(string_split(lower({c}), ' '), lambda t: regexp_replace(t, '[^\p{{L}}\p{{N}}\p{{M}}_]', '', 'g')), lambda t: t <> '')"


def folded_tokens(c: str) -> str:
    t = f"lower({collapsed(c)})"
    for a, b in _FOLDS:
        t = f"replace({t}, '{a}', '{b}')"
    return rf"regexp_extract_all(nfc_normalize({t}), '[\p{{L}}\p{{N}}\p{{M}}_]+')"


def critical(c: str) -> str:
    return rf"list_transform(regexp_extract_all(coalesce({c}, ''), '\(\s*{_NUMBER}\s*\)|{_NUMBER}'), lambda v: lower(replace(regexp_replace(v, '{_SPACE}+', '', 'g'), '−', '-')))"


def distance(r: str, h: str) -> str:
    """Edit distance in code points: the engine's own counts bytes, so each code point of the pair becomes one of the 127 that are a byte."""
    known = f"list_sort(list_distinct(regexp_extract_all({r} || {h}, '(?s).')))"
    coded = lambda x: f"translate({x}, array_to_string({known}, ''), array_to_string(list_transform(range(1, 128), lambda i: chr(CAST(i AS INT))), ''))"
    return f"CASE WHEN len({known}) > 127 THEN error('too many code points') ELSE levenshtein({coded(r)}, {coded(h)}) END"


def kind(c: str) -> str:
    t = collapsed(f"replace({c}, chr(173), '')")
    return rf"""CASE WHEN regexp_matches({t}, '^[0-9]+$') THEN 'page_number' WHEN regexp_matches({t}, '^[0-9]{{3,4}}\s+[A-Z][A-Z0-9 /&()''.,\-]*$') OR regexp_matches({t}, '^[0-9]{{3,4}}(\.[0-9]+)+\s+[A-Z]') THEN 'section_heading'
        WHEN regexp_matches({t}, '(?i)^(fig\.|figure|table)\s*[a-z0-9_.\-]+') THEN 'caption' WHEN regexp_matches({t}, '^[A-Z][A-Z0-9]{{1,10}}\s*:') OR regexp_matches({t}, '^([0-9]+\)|[A-Za-z]\))\s+') THEN 'table_like' ELSE 'text' END"""
