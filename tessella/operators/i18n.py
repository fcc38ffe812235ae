"""Translation sheets: language columns by header, wide to long with keys, fallback and an audit."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import header_key, is_blank, trimmed, utf16_head

#: Header patterns and the language each stands for, tried in this order.
HEADER_LANGUAGES = [
    ("繁体|傳統|traditional", "zh-TW"),
    ("简体|简中|simplified", "zh-CN"),
    ("中文|汉语|chinese", "zh"),
    ("英语|英文|english", "en"),
    ("印尼|indonesia|bahasa.*indo", "in"),
    ("马来|malay", "ms"),
    ("葡萄|portugu", "pt"),
    ("西班牙|espa|spanish", "es"),
    ("印地|hindi", "hi"),
    ("越南|việt|vietnamese", "vi"),
    ("土耳其|türk|turkish", "tr"),
    ("阿拉伯|عرب|arabic", "ar"),
    ("泰语|泰文|thai|ไทย", "th"),
    ("日语|日文|日本|japanese", "ja"),
    ("韩语|韩文|朝鲜|korean", "ko"),
    ("俄语|俄文|russian", "ru"),
    ("德语|德文|german|deutsch", "de"),
    ("法语|法文|french|français", "fr"),
]


@dataclass(frozen=True)
class HeaderRule:
    """A rule of the user's own: ``kind`` is exact (any case), regex or fuzzy (either holds the other)."""

    match: str
    lang: str
    kind: str = "fuzzy"


def parse_rules(raw: Sequence[dict]) -> list[HeaderRule]:
    """Rules from dictionaries with match, lang and optionally type; ValueError names the bad one."""
    out = []
    for i, r in enumerate(raw):
        kind = r.get("type") or "fuzzy"
        if not str(r.get("match") or "").strip() or not str(r.get("lang") or "").strip():
            raise ValueError(f"rule {i + 1} needs match and lang: {r}")
        if kind not in ("exact", "regex", "fuzzy"):
            raise ValueError(f"rule {i + 1}: type must be exact, regex or fuzzy, not {kind}")
        if kind == "regex":
            re.compile(r["match"])
        out.append(HeaderRule(r["match"], r["lang"], kind))
    return out


def _matches(header: Column, rule: HeaderRule) -> Column:
    if rule.kind == "exact":
        return F.lower(header) == rule.match.strip().lower()
    if rule.kind == "regex":
        return header.rlike(f"(?i){rule.match}")
    mine, other = header_key(header), header_key(F.lit(rule.match))
    return (other != "") & (mine != "") & (mine.contains(other) | other.contains(mine))


def header_language(header: Column, rules: Sequence[HeaderRule] = ()) -> Column:
    """Language code of a header, own rules first; null if none matches. Blank headers have none."""
    name = trimmed(header)
    found = F.lit(None).cast("string")
    for pattern, lang in reversed(HEADER_LANGUAGES):
        found = F.when(name.rlike(f"(?iu){pattern}"), F.lit(lang)).otherwise(found)
    for rule in reversed(list(rules)):
        found = F.when(_matches(name, rule), F.lit(rule.lang)).otherwise(found)
    return F.when(~is_blank(header), found)


def _is_base(lang: str | None) -> bool:
    return lang in ("zh", "zh-CN")


@dataclass
class Translations:
    """``entries`` (lang, key, text), ``missing`` (row, key, langs), ``skipped`` (group rows), and how
    the headers were understood."""

    entries: DataFrame
    missing: DataFrame
    skipped: DataFrame
    languages: list[tuple[str, str]]
    base_header: str | None


def export_translations(
    rows: DataFrame,
    headers: Sequence[str],
    key_column: str | None = None,
    columns: Sequence[str | int] | None = None,
    fallback: str = "en",
    group_rows: bool = True,
    rules: Sequence[HeaderRule] = (),
    synthesised: bool = False,
) -> Translations:
    """Wide rows (``_row`` and a text column for each header) to (lang, key, text).

    - Each language is taken from its first header; ``columns`` keeps some by place, code or header.
    - The key is the key column's text, or ``txt_{UTF-16 unit}{row}`` of the base text (first header
      that has any text), or ``txt_row_{row}``.
    - A group row (only Chinese filled, other languages there but blank) is skipped.
    - A blank cell of a language other than Chinese takes the fallback language's text.
    - Text of several lines is cut into ``key_0``, ``key_1`` ...; of equal keys the last row's wins.
    """
    spark = rows.sparkSession
    found = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i int, h string").select("i", "h", header_language(F.col("h"), rules).alias("lang"))
    lang_of = {r.h: r.lang for r in found.collect()}  # a row a header
    if key_column is not None and key_column.strip() not in [h.strip() for h in headers]:
        raise ValueError(f"no header {key_column!r}; there are: {', '.join(h for h in headers if h)}")
    key_header = next((h for h in headers if key_column is not None and h.strip() == key_column.strip()), None)
    base_lang_header = next((h for h in headers if _is_base(lang_of[h])), None)
    text = {h: trimmed(F.coalesce(F.col(f"`{h}`"), F.lit(""))) for h in headers}
    base_header = None
    if not synthesised and headers:
        has = rows.agg(*[F.max(text[h] != "").alias(f"c{i}") for i, h in enumerate(headers)]).first()
        base_header = next((h for i, h in enumerate(headers) if h.strip() and has[f"c{i}"]), None)
    wanted = {c if isinstance(c, int) else c.strip().lower() for c in columns} if columns else None
    languages: list[tuple[str, str]] = []
    for i, h in enumerate(headers):
        lang = lang_of[h]
        if h == key_header or not lang or lang in [x for x, _ in languages]:
            continue
        if wanted is None or wanted & {i + 1, lang.lower(), h.strip().lower()}:
            languages.append((lang, h))
    fallback = fallback.strip().lower()
    fallback_header = next((h for lang, h in languages if lang.lower() == fallback), None)
    fallback_text = text[fallback_header] if fallback_header else F.lit("")
    others = [(lang, h) for lang, h in languages if not _is_base(lang)]

    group = F.lit(False)
    if group_rows and base_lang_header and others:
        group = text[base_lang_header] != ""
        for _, h in others:
            group = group & (text[h] == "")
    row_key = F.concat(F.lit("txt_row_"), F.col("_row").cast("string"))
    base_text = F.lit("") if key_header or not base_header else text[base_header]
    if key_header:
        key = F.when(text[key_header] != "", text[key_header]).otherwise(row_key)
    else:
        key = F.when(base_text != "", F.concat(F.lit("txt_"), utf16_head(base_text).cast("string"), F.col("_row").cast("string"))).otherwise(row_key)
    lacking = F.array_compact(F.array(*[F.when(text[h] == "", F.lit(lang)) for lang, h in others])) if others else F.array().cast("array<string>")
    no_base = F.lit(bool(not key_header and base_header)) & (base_text == "")
    base_name = F.array(F.lit(lang_of.get(base_header) or base_header))
    missing_key = key if key_header else F.when(base_text != "", base_text).when(fallback_text != "", fallback_text).otherwise(key)

    def value(lang: str, h: str) -> Column:
        takes = not _is_base(lang) and lang.lower() != fallback
        return F.when(text[h] == "", fallback_text).otherwise(text[h]) if takes else text[h]

    cells = F.array(*[F.struct(F.lit(lang).alias("lang"), value(lang, h).alias("text")) for lang, h in languages])
    work = rows.select(
        "_row", group.alias("_group"), key.alias("_key"), (cells if languages else F.array().cast("array<struct<lang:string,text:string>>")).alias("_cells"),
        F.when(no_base, row_key).otherwise(missing_key).alias("_missing_key"), F.when(no_base, base_name).otherwise(lacking).alias("_missing"),
    )
    data = work.filter(~F.col("_group"))
    each = data.select("_row", "_key", F.explode("_cells").alias("c")).select("_row", "_key", "c.lang", "c.text").filter("text <> ''")
    lines = F.filter(F.transform(F.split("text", r"\r?\n"), trimmed), lambda x: x != "")
    several = F.col("text").contains("\n")
    parts = each.select("_row", "lang", "_key", several.alias("_several"), F.posexplode(F.when(several, lines).otherwise(F.array("text"))).alias("_i", "text"))
    named = parts.withColumn("key", F.when(F.col("_several"), F.concat_ws("_", "_key", F.col("_i").cast("string"))).otherwise(F.col("_key")))
    entries = named.groupBy("lang", "key").agg(F.max_by("text", F.struct("_row", "_i")).alias("text"))
    missing = data.filter(F.size("_missing") > 0).select(F.col("_row").alias("row"), F.col("_missing_key").alias("key"), F.col("_missing").alias("langs"))
    return Translations(entries, missing, work.filter("_group").select("_row"), languages, base_header)


def key_counts(entries: DataFrame) -> DataFrame:
    """``lang, n_keys`` and whether the languages' counts differ."""
    counts = entries.groupBy("lang").agg(F.count("*").alias("n_keys"))
    differ = counts.agg((F.count_distinct("n_keys") > 1).alias("uneven"))
    return counts.crossJoin(F.broadcast(differ))  # one row
