"""Column expressions over strings, placeholders, URLs and spaces. All are native; none is a UDF."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingspan.schema import CONTEXT_FIELDS, PLATFORM_ORDER, PLURAL_FORMS, TAG_PRIMARY_ORDER

# Patterns that findings are defined by. (?U) makes \w, \s and \b Unicode-aware.
UNIVERSAL = r"\[%[^\]]*\]"
STRINGSDICT = r"(?U)%\d*\$?#@\w+@"
BARE = r"%(?:\d+\$)?0*\d*(?:\.\d+)?(?:hh|h|ll|l|L|z|t|j)?[@diouxXeEfFgGcCsS]"
FORMAT = r"(?<!%)%(?!%)(?:\d+\$)?[-+#0 ]*(?:\d+|\*)?(?:\.(?:\d+|\*))?(?:hh|h|ll|l|L|z|t|j)?[@diuoxXfFeEgGcCsSpa]"
EM_DASH = "—"
INVISIBLE = "[  ᠎ -​    　﻿]"
SPACE_NAMES = {
    " ": "NBSP", " ": "NARROW-NBSP", "​": "ZWSP", "﻿": "BOM", " ": "LINE-SEP", " ": "PARA-SEP",
    "　": "IDEOGRAPHIC-SPACE", " ": "MATH-SPACE",
}
EMOTICON = r"[:;=]['\-^]?[()]"
URL_TAIL = r"[.,;:!?)\]}'\"]+$"
CYRILLIC = r"[Ѐ-ԯ]+"
CYRILLIC_PHRASE = r"(^|[^Ѐ-ԯ])([Ѐ-ԯ]+(?:[ \t]+[Ѐ-ԯ]+)+)"
QUOTES = "\"«“‘„»”’'`"
CAP = r"(?iU)(\d+)\s*(?:char|character)s?"
#: What counts as white space at the ends of a value.
SPACES = r"\u0009-\u000D\u001C- \u0085   -     　"
URL = rf"https?://[^{SPACES}\"<>]+"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Without white space at both ends, Unicode spaces included."""
    return F.regexp_replace(value, f"^[{SPACES}]+|[{SPACES}]+$", "")


def matches(value: Column | str, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(group))


def count_of(value: Column, piece: str) -> Column:
    return ((F.char_length(value) - F.char_length(F.replace(value, F.lit(piece), F.lit("")))) / len(piece)).cast("int")


def snippet(value: Column | str, limit: int = 70) -> Column:
    return F.when(F.char_length(value) > limit, F.concat(F.substring(value, 1, limit), F.lit("…"))).otherwise(_col(value))


def casefold(value: Column | str) -> Column:
    """Full folding; the empty text keeps the optimiser from taking lower(upper(x)) for lower(x)."""
    return F.lower(F.concat(F.upper(value), F.lit("")))


def one_line(value: Column | str) -> Column:
    return strip(F.regexp_replace(value, f"[{SPACES}]+", " "))


# Placeholders


def universal_tokens(value: Column | str) -> Column:
    return matches(value, UNIVERSAL)


def placeholder_type(token: Column) -> Column:
    """Conversion letter of a universal token; '?' if there is none."""
    return F.coalesce(F.nullif(F.regexp_replace(token, r"(?U)[\[\]%\d$.\-+# ]", ""), F.lit("")), F.lit("?"))


def placeholder_types(value: Column | str) -> Column:
    """The multiset of types as a sorted array."""
    return F.array_sort(F.transform(universal_tokens(value), placeholder_type))


def multiset_text(types: Column) -> Column:
    """'%s x2, %i x1' with a multiplication sign, or 'none'."""
    one = F.transform(F.array_sort(F.array_distinct(types)), lambda t: F.concat(F.lit("%"), t, F.lit("×"), F.size(F.filter(types, lambda x: x == t)).cast("string")))
    return F.when(F.size(types) == 0, "none").otherwise(F.array_join(one, ", "))


def is_indexed(token: Column) -> Column:
    return token.rlike(r"^\[%\d+\$")


def without_wrapped(value: Column | str) -> Column:
    """What is left when universal tokens and substitution variables are peeled off."""
    return F.regexp_replace(F.regexp_replace(value, UNIVERSAL, ""), STRINGSDICT, "")


def placeholder_signature(value: Column | str) -> Column:
    """Placeholders without their positions, sorted; wrapped and bare ones stay distinct."""
    wrapped = F.transform(universal_tokens(value), lambda t: F.regexp_replace(t, r"^\[%\d+\$", "[%"))
    bare = F.transform(matches(without_wrapped(value), FORMAT), lambda t: F.regexp_replace(t, r"^%\d+\$", "%"))
    return F.array_sort(F.concat(wrapped, bare))


# Hygiene of values


def space_name(char: Column) -> Column:
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(SPACE_NAMES.items())])
    return F.coalesce(F.try_element_at(names, char), F.format_string("U+%04X", F.ascii(char)))


def invisible_spaces(value: Column | str) -> Column:
    return F.array_distinct(matches(value, INVISIBLE))


def parens(value: Column | str) -> tuple[Column, Column]:
    plain = F.regexp_replace(value, EMOTICON, "")
    return count_of(plain, "("), count_of(plain, ")")


def edge_side(value: Column | str) -> Column:
    """'leading' or 'trailing' if white space is at an end of a value that isn't blank; else null."""
    bare = strip(value)
    return F.when((bare != "") & (bare != _col(value)), F.when(_col(value).rlike(f"^[{SPACES}]"), "leading").otherwise("trailing"))


def longest_gap(value: Column | str) -> Column:
    """Length of the longest run of two or more plain spaces; null if there is none."""
    return F.array_max(F.transform(matches(value, " {2,}"), F.char_length))


def urls(value: Column | str) -> Column:
    return F.array_sort(F.transform(matches(value, URL), lambda u: F.regexp_replace(u, URL_TAIL, "")))


def cyrillic_run(value: Column | str) -> Column:
    return F.get(matches(value, CYRILLIC), F.lit(0))


def has_loose_cyrillic_phrase(value: Column | str) -> Column:
    """Two or more Cyrillic words of ten letters or more in all, not right after a quotation mark."""
    quoted = F.create_map(*[x for q in QUOTES for x in (F.lit(q), F.lit(True))])
    return F.exists(
        matches(value, CYRILLIC_PHRASE, 0),
        lambda run: ~F.coalesce(F.try_element_at(quoted, F.substring(run, 1, 1)), F.lit(False)) & (F.char_length(F.regexp_replace(run, r"[^Ѐ-ԯ]", "")) >= 10),
    )


# Context blocks


def context_body(context: Column | str, field: str) -> Column:
    """Body of a field, up to the next known field; null if the field is absent."""
    return F.get(matches(context, rf"(?ms)^{field}:(.*?)(?=^(?:{'|'.join(CONTEXT_FIELDS)}):|\z)", 1), F.lit(0))


def context_fields(context: Column | str) -> Column:
    return F.struct(*[context_body(context, f).alias(f) for f in CONTEXT_FIELDS])


def build_context(surface: Column, type_: Column, context: Column, constraints: Column) -> Column:
    line = lambda name, body: F.concat(F.lit(f"{name}: "), body)
    return F.concat_ws("\n", line("Surface", surface), line("Type", type_), line("Context", context), line("Constraints", constraints))


def smallest_cap(context: Column | str) -> Column:
    return F.array_min(F.transform(matches(context, CAP, 1), lambda n: n.cast("long")))


def family_of(key: Column | str) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(key, r"_?\d+[MF]?$", ""), F.lit("")), _col(key))


# Keys, plurals, flags


def collapse_key_name(by_platform: Column) -> Column:
    """The one distinct non-empty name of a per-platform map; null if there are several."""
    names = F.array_distinct(F.filter(F.map_values(by_platform), lambda n: n != ""))
    return F.when(F.size(names) == 1, F.get(names, F.lit(0)))


def display_key(name: Column | str, by_platform: Column | str) -> Column:
    entries = F.array_sort(F.map_entries(by_platform))
    return F.coalesce(_col(name), F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ", "))


def summary_key(name: Column | str, by_platform: Column | str) -> Column:
    """The name, or that of the first platform in order."""
    first = [F.try_element_at(_col(by_platform), F.lit(p)) for p in PLATFORM_ORDER]
    return F.coalesce(_col(name), *[F.nullif(x, F.lit("")) for x in first])


def has_platform(platforms: Column | str, platform: str) -> Column:
    return (F.size(platforms) == 0) | F.array_contains(platforms, platform)


def valid_key_name(name: Column | str) -> Column:
    return _col(name).rlike("^[A-Za-z][A-Za-z0-9_]*$")


def plural_value(raw: Column | str) -> Column:
    """A map of known plural forms from JSON text; anything else is the form 'other'."""
    parsed = F.from_json(raw, "map<string,string>")
    forms = F.map_filter(parsed, lambda k, v: k.isin(*PLURAL_FORMS))
    return F.when(parsed.isNull() | (F.size(forms) == 0), F.create_map(F.lit("other"), _col(raw))).otherwise(forms)


def ordered_platforms(platforms: Column | str) -> Column:
    """Known platforms in their order, then the others sorted, each once."""
    known = F.array(*[F.lit(p) for p in PLATFORM_ORDER])
    return F.concat(F.filter(known, lambda p: F.array_contains(platforms, p)), F.array_sort(F.array_distinct(F.array_except(platforms, known))))


def value_matches(sent: Column, stored: Column | str, plural: Column) -> Column:
    """Flat values must be equal; of plural ones every form sent must be stored."""
    forms = F.from_json(stored, "map<string,string>")
    return F.when(plural, F.forall(F.map_entries(F.from_json(sent, "map<string,string>")), lambda e: F.try_element_at(forms, e["key"]).eqNullSafe(e["value"]))).otherwise(sent.eqNullSafe(_col(stored)))


def truthy(value: Column | str) -> Column:
    return F.lower(strip(_col(value).cast("string"))).isin("yes", "true", "1")


def falsy_or(value: Column | str, default: bool) -> Column:
    text = F.lower(strip(_col(value).cast("string")))
    return F.when(text.isin("yes", "true", "1"), True).when(text.isin("no", "false", "0"), False).otherwise(default)


def primary_tag(tags: Column | str) -> Column:
    order = F.array(*[F.lit(t) for t in TAG_PRIMARY_ORDER])
    return F.coalesce(F.get(F.filter(order, lambda t: F.array_contains(tags, t)), F.lit(0)), F.lit("other"))


def swap_separator(lang: Column | str) -> Column:
    """A language code with '-' and '_' exchanged."""
    return F.translate(lang, "-_", "_-")


def unescape_json(raw: Column | str) -> Column:
    """The text of a string literal's inside; itself if it is no JSON string."""
    return F.coalesce(F.get(F.from_json(F.concat(F.lit('["'), raw, F.lit('"]')), "array<string>"), F.lit(0)), _col(raw))


def android_field(key: Column | str) -> Column:
    return F.regexp_replace(key, "[^A-Za-z0-9_]", "_")


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
