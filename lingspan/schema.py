"""The corpus as tables: names, constants and schemas.

keys: one row a UI string key. translations: one row a (key, language, plural form); form '' is a flat value. A missing
translation has no row; an empty one has the value ''.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# Names that the data carries.
PLURAL_FORMS = ("zero", "one", "two", "few", "many", "other")
SOURCE_LANG = "en"
CO_SOURCE_LANG = "ru"
PLATFORM_ORDER = ("ios", "android", "web", "other")
META_FIELDS = ("platforms", "context", "filenames")
CONTEXT_FIELDS = ("Surface", "Type", "Context", "Constraints", "Placeholders", "Register", "Tone")
OPTIONAL_CONTEXT_FIELDS = ("Constraints", "Placeholders", "Register", "Tone")
DEFAULT_LANGUAGES = ("ar", "da", "de", "en", "es", "fr", "hi", "id", "it", "ja", "ko", "ms", "nb", "nl", "pl", "pt_BR", "ru", "sv", "tr", "vi", "zh_CN")
TAG_VOCABULARY = ("brand", "ui", "domain", "beverage", "unit", "legal")
TAG_PRIMARY_ORDER = ("legal", "unit", "domain", "ui", "beverage")

KEYS = (
    "rec_id string, key_id bigint, ord bigint, key_name string, key_by_platform map<string,string>, platforms array<string>, plural boolean, "
    "archived boolean, context string, char_limit int, filenames map<string,string>, dirty_meta array<string>"
)
TRANSLATIONS = ("rec_id string, lang string, form string, value string, is_unverified boolean, is_dirty boolean")
FINDINGS = ("rec_id string, key string, lang string, severity string, code string, token string, snippet string")
GLOSSARY = ("term string, term_id bigint, description string, case_sensitive boolean, translatable boolean, forbidden boolean, tags array<string>")
GLOSSARY_T = ("term string, lang string, text string, note string")
QA_ISSUES = ("key_id bigint, lang string, translation_id bigint, issues array<string>, value string, qa string")


@dataclass(frozen=True)
class Corpus:
    """Immutable: every edit gives a new one."""

    keys: DataFrame
    translations: DataFrame


@dataclass(frozen=True)
class Glossary:
    terms: DataFrame
    texts: DataFrame
