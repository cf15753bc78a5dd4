"""Labels derived from record fields: size, region, type, notes, scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.text import any_contains, any_word, as_col, strip

_UNITS = [(1_000_000_000_000, "T"), (1_000_000_000, "B"), (1_000_000, "M")]


def _scaled(params: Column, below: Column) -> Column:
    chain = F.when(F.coalesce(params, F.lit(0)) == 0, F.lit(""))
    for unit, letter in _UNITS:
        whole = F.bround(params / F.lit(float(unit)), 0).cast("bigint").cast("string")
        chain = chain.when(params >= unit, F.concat(whole, F.lit(letter)))
    return chain.otherwise(below)


def size_label(params: Column | str) -> Column:
    """236000000000 -> 236B; small numbers as they are; nothing for 0 or null."""
    params = as_col(params)
    return _scaled(params, params.cast("string"))


def size_label_text(raw: Column | str) -> Column:
    """Same for a raw text field: text that is no number passes through."""
    raw = as_col(raw)
    number = raw.try_cast("double")
    return F.when(raw.isNull(), "").when(number.isNull(), raw).otherwise(
        _scaled(number, raw)
    )


def size_or_dash(params: Column | str) -> Column:
    return F.coalesce(F.nullif(size_label(params), F.lit("")), F.lit(S.DASH))


def size_from_million(params: Column | str) -> Column:
    """Sizes below a million stay empty."""
    return _scaled(as_col(params), F.lit(""))


def region(org: Column | str, country: Column | str) -> Column:
    slug = F.translate(F.lower(F.coalesce(as_col(org), F.lit(""))), " -", "")
    home = (F.upper(F.coalesce(as_col(country), F.lit(""))) == "CN") | any_contains(slug, S.DOMESTIC_ORGS)
    return F.when(home, S.DOMESTIC).otherwise(S.FOREIGN)


def openness(is_open: Column | str) -> Column:
    is_open = as_col(is_open)
    return F.when(is_open, S.OPEN).when(~is_open, S.CLOSED).otherwise(S.UNKNOWN)


def is_open_record(record: Column | str) -> Column:
    """Open by the flag when the record has the key at all, else by licence.

    ``record`` is a map: a key that is present with a null value means closed.
    """
    record = as_col(record)
    flag = F.coalesce(record["is_open_source"] == "true", F.lit(False))
    lic = F.coalesce(record["license"], F.lit(""))
    return F.when(F.map_contains_key(record, "is_open_source"), flag).otherwise(
        ~lic.isin("", "proprietary")
    )


def modalities(raw: Column | str) -> Column:
    """The field is a boolean or a list; the list, or null."""
    raw = as_col(raw)
    return F.when(F.ltrim(raw).startswith("["), F.from_json(raw, "array<string>"))


def is_multimodal(raw: Column | str) -> Column:
    return F.coalesce(
        (as_col(raw) == "true") | (F.size(modalities(raw)) > 0), as_col(raw) == "true", F.lit(False)
    )


def _has(text: Column, words: list[str], word_boundary: bool) -> Column:
    return any_word(text, words) if word_boundary else any_contains(text, words)


def _names(name: Column | str, entity_id: Column | str) -> Column:
    return F.concat_ws(" ", F.lower(F.coalesce(as_col(name), F.lit(""))), F.lower(F.coalesce(as_col(entity_id), F.lit(""))))


def entity_type(name, entity_id, multimodal, is_moe, params, word_boundary: bool = False) -> Column:
    """Code, speech, multimodal, base or domain; the first rule that holds."""
    both = _names(name, entity_id)
    large = F.coalesce(as_col(params), F.lit(0)) >= 1_000_000_000
    return (
        F.when(_has(both, S.CODE_WORDS, word_boundary), "代码")
        .when(_has(both, S.AUDIO_WORDS, word_boundary), "语音")
        .when(as_col(multimodal), "多模态")
        .when(F.coalesce(as_col(is_moe), F.lit(False)) | large, "基座")
        .otherwise("领域")
    )


def reasoning(name, entity_id, index, word_boundary: bool = False) -> Column:
    hit = _has(_names(name, entity_id), S.REASONING_WORDS, word_boundary)
    return F.when(hit | (as_col(index) > 40), "thinking").otherwise("non-thinking")


def percent_scale(x: Column | str) -> Column:
    x = as_col(x)
    return F.when(x <= 1, x * 100).otherwise(x)


def tier(x: Column | str, top: float, top_label: str, good: float, good_label: str) -> Column:
    pct = percent_scale(x)
    return F.when(pct >= top, top_label).when(pct >= good, good_label)


def price_tier(price_in: Column | str, price_out: Column | str) -> Column:
    total = as_col(price_in).try_cast("double") + as_col(price_out).try_cast("double")
    return F.when(total <= 1, "低成本").when(total >= 20, "高端定价")


def license_name(raw: Column | str) -> Column:
    """Known licences by name, others readable; none for closed or empty."""
    raw = as_col(raw)
    known = F.create_map(*[F.lit(v) for pair in S.LICENSE_NAMES.items() for v in pair])
    shown = F.coalesce(F.try_element_at(known, F.lower(raw)), F.initcap(F.replace(raw, F.lit("_"), F.lit(" "))))
    return F.when(~F.coalesce(raw, F.lit("")).isin("", "proprietary"), shown)


def record_note(is_moe, params, context, modality_list, gpqa, swe, price_in, price_out, lic, modalities: int | None = 3) -> Column:
    """Up to eight labels joined by a full-width semicolon; absent ones add nothing.

    The first ``modalities`` of the list are named; None names all.
    """
    size = F.nullif(size_label(params), F.lit(""))
    moe = F.when(as_col(is_moe), F.concat_ws("；", F.lit("MoE架构"), F.concat(size, F.lit("参数"))))
    window = as_col(context)
    long_context = F.when(
        window >= 100_000, F.concat(F.floor(window / 1000).cast("string"), F.lit("k上下文"))
    )
    parts = F.filter(as_col(modality_list), lambda m: F.coalesce(m, F.lit("")) != "")
    shown = parts if modalities is None else F.slice(parts, 1, modalities)
    modal = F.when(F.size(parts) > 0, F.concat(F.lit("统一"), F.array_join(shown, "+")))
    return F.concat_ws(
        "；",
        moe,
        long_context,
        modal,
        tier(gpqa, 90, "顶级推理能力", 80, "强推理能力"),
        tier(swe, 70, "顶级编码能力", 50, "强编码能力"),
        price_tier(price_in, price_out),
        license_name(lic),
    )


def fixed(x: Column, digits: int) -> Column:
    """Text with fixed decimals, half to even; null stays null."""
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", F.bround(x, digits)))


def score_text(x: Column | str) -> Column:
    """Fraction or percent to ``x.x%``; a dash for null."""
    return F.coalesce(F.concat(fixed(percent_scale(x), 1), F.lit("%")), F.lit(S.DASH))


def rating_text(x: Column | str) -> Column:
    return F.coalesce(F.bround(as_col(x), 0).cast("bigint").cast("string"), F.lit(S.DASH))


def win_rate_text(x: Column | str) -> Column:
    return F.coalesce(F.concat(fixed(as_col(x), 1), F.lit("%")), F.lit(S.DASH))


def price_text(x: Column | str) -> Column:
    """Two decimals; 0 counts as unknown."""
    x = F.nullif(as_col(x), F.lit(0.0))
    return F.coalesce(F.concat(F.lit("$"), fixed(x, 2)), F.lit(S.DASH))


def thousands(x: Column | str) -> Column:
    return F.coalesce(F.format_number(F.nullif(as_col(x), F.lit(0)), 0), F.lit(S.DASH))


def coverage_grade(pct: Column | str, good: float = 90, fair: float = 50) -> Column:
    pct = as_col(pct)
    return F.when(pct >= good, "ok").when(pct >= fair, "warn").otherwise("fail")


def detail_url(base: str, entity_id: Column | str) -> Column:
    key = F.coalesce(as_col(entity_id), F.lit(""))
    return F.when(key != "", F.concat(F.lit(base.rstrip("/") + "/"), key)).otherwise("")


def license_tag(tags: Column | str) -> Column:
    found = F.get(F.filter(as_col(tags), lambda t: t.startswith("license:")), F.lit(0))
    return F.replace(found, F.lit("license:"), F.lit(""))


def verification_text(source: str, repo: Column, size: Column, lic: Column, kind: Column) -> Column:
    """Parts joined by a middle dot; null and empty parts are left out."""
    filled = lambda c: F.nullif(c, F.lit(""))
    return F.concat_ws(
        " · ",
        F.concat(F.lit(f"{source}("), repo, F.lit(")")),
        F.concat(F.lit("参数量="), filled(size)),
        filled(lic),
        filled(kind),
    )


def candidate_ids(name, company, org_id) -> Column:
    """Ids under which a record may be registered, most likely first, no repeats."""
    name = as_col(name)
    slug = F.regexp_replace(F.replace(F.lower(name), F.lit(" "), F.lit("-")), r"[^a-z0-9\-.]", "-")
    # both sides lose spaces and dashes, so hyphenated org keys match too
    org_key = F.translate(F.lower(F.coalesce(as_col(org_id), F.lit(""))), " -", "")
    pairs = [(k.replace("-", ""), v) for k, v in S.ORG_SLUGS.items()]
    by_org = F.create_map(
        *[x for k, v in pairs for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))]
    )
    under = lambda owner: F.array(F.concat(owner, F.lit("/"), name), F.concat(owner, F.lit("/"), slug))
    none = F.array().cast("array<string>")
    from_org = F.coalesce(F.flatten(F.transform(F.try_element_at(by_org, org_key), under)), none)
    company = F.coalesce(as_col(company), F.lit(""))
    owner = strip(F.get(F.split(F.replace(F.lower(company), F.lit(" "), F.lit("-")), "/"), F.lit(0)))
    from_company = F.when(company != "", under(owner)).otherwise(none)
    return F.array_distinct(F.concat(from_org, from_company, F.array(name)))


def flag_country(x: Column | str) -> Column:
    x = as_col(x)
    chain = reduce(lambda acc, kv: acc.when(x.contains(kv[0]), kv[1]), S.FLAG_COUNTRIES.items(), F)
    return chain.otherwise("")


def price_or_dash(x: Column | str) -> Column:
    """Price as it is, behind a dollar sign; a dash for null."""
    return F.coalesce(F.concat(F.lit("$"), as_col(x).cast("string")), F.lit(S.DASH))
