"""SQL that gives the same rows as the queries of the general problems."""

from florilege.operators.quality import MISSING

_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_EDGE = r"[\s\x0b\x{85}\pZ\pP<>]"
_LIST = ", ".join("'" + m.replace("'", "''") + "'" for m in MISSING)
_UNFIT = (
    f"v = '' OR regexp_matches(v, '^{_WS}|{_WS}$') OR NOT regexp_matches(v, '[\\pL\\pN]') OR lower(regexp_replace(v, '^{_EDGE}+|{_EDGE}+$', '', 'g')) IN ({_LIST})"
    r" OR regexp_matches(v, '\[\[|\]\]|\{\{|\}\}|''''|<!--|-->|</?[A-Za-z][^<>]*>|<[A-Za-z]+\s*/?$')"
    r" OR regexp_matches(v, '&(?:[A-Za-z][A-Za-z0-9]+|#[0-9]+|#[xX][0-9A-Fa-f]+);') OR regexp_matches(v, '[\p{Cc}\x{FFFD}]')"
    r" OR regexp_matches(v, '[\x{C2}\x{C3}][\x{80}-\x{BF}]|\x{E2}\x{20AC}|\x{C3}[\x{2000}-\x{2122}]') OR regexp_matches(v, '(?i)://\S|www\.\S|mailto:|\S@\S+\.[a-z]{2}')"
)

_BAD_DATE = r"""(NOT regexp_full_match(d, CASE p WHEN 'day' THEN '-?\d{4}-\d{2}-\d{2}' WHEN 'month' THEN '-?\d{4}-\d{2}' ELSE '-?\d{4}' END)
    OR try_cast(CASE p WHEN 'day' THEN ltrim(d, '-') WHEN 'month' THEN ltrim(d, '-') || '-01' ELSE ltrim(d, '-') || '-01-01' END AS date) IS NULL
    OR try_cast(regexp_extract(d, '^-?(\d{4})', 1) AS int) = 0 OR (NOT starts_with(d, '-') AND try_cast(left(d, 4) AS int) > year(loaded_at)))"""


def _profile() -> str:
    """A SELECT for each column of quotes: plain aggregates of its values."""
    agent = ["name", "kind", "link_site", "link_lang", "link_title", "played_by"]
    numbers = ["quote_no", "page_id", "revision_id", "source.work_year", "source.episode_season", "provenance.unparsed_annotations"]
    arrays = ["about", "source.parts", "source.cite_templates", "context_path", "annotations", "translations", "links"]
    texts = "id content_hash wiki_language page_title page_type text wikitext language language_from kind status".split()
    texts += [f"speaker.{a}" for a in agent] + [f"provenance.{x}" for x in ("speaker_from", "source_from", "status_from")]
    texts += [f"source.{x}" for x in (
        "raw complete work_title work_type work_link_site work_link_title episode_series episode_number episode_title date_iso date_end_iso date_precision date_raw "
        "locator_page locator_chapter locator_part locator_act_scene locator_line publication publisher isbn url occasion").split()]  # fmt: skip
    out = []
    for name in [*numbers, *arrays, *texts, "loaded_at"]:
        shown = "strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f')" if name == "loaded_at" else name if name in numbers else f"len({name})" if name in arrays else f"{name}::varchar"
        bad = f"v IS NOT NULL AND ({_UNFIT})" if name in ("source.work_title", "speaker.name") else f"d IS NOT NULL AND {_BAD_DATE}" if name == "source.date_iso" else "false"
        value = f"SELECT *, {name} AS v, source.date_iso AS d, source.date_precision AS p FROM quotes"
        out.append(
            f"SELECT '{name}' AS \"column\", load_no, count(*) AS n_rows, count(*) - count(v) AS n_null, round((count(*) - count(v)) / count(*), 6) AS null_rate, count(DISTINCT v) AS n_distinct, "
            f"min({shown})::varchar AS min_value, max({shown})::varchar AS max_value, count_if({bad})::bigint AS n_unfit FROM ({value}) GROUP BY load_no"
        )
    return " UNION ALL ".join(out)


SQL = {
    "p5_profile": _profile(),
    "p1_plain": r"""
        WITH t AS (SELECT source_id, CASE WHEN date_raw IS NULL OR trim(date_raw) = '' THEN date_iso ELSE date_raw END AS t FROM sources),
        d AS (SELECT source_id, CASE WHEN length(t) = 10 AND contains(t, '-') THEN try_cast(t AS date)::varchar WHEN length(t) = 8 THEN try_strptime(t, '%Y%m%d')::date::varchar
          WHEN length(t) = 10 THEN strftime(make_timestamp(try_cast(t AS bigint) * 1000000), '%Y-%m-%dT%H:%M:%SZ') WHEN length(t) = 13 THEN strftime(make_timestamp(try_cast(t AS bigint) // 1000 * 1000000), '%Y-%m-%dT%H:%M:%SZ')
          WHEN length(t) = 14 THEN strftime(try_strptime(t, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%SZ') ELSE t END AS date_norm
          FROM t WHERE regexp_full_match(t, '[1-9]\d{3}|[1-9]\d{7}|[1-9]\d{9}|[1-9]\d{12}|[1-9]\d{13}|[1-9]\d{3}-\d{2}-\d{2}'))
        SELECT source_id, date_norm FROM d WHERE date_norm IS NOT NULL""",
    "p2_found": r"""
        SELECT DISTINCT 'page' AS root_kind, revision_id AS root_id, node_path, regexp_extract(node_path, '^(.*)\.[^.]*$', 1) AS parent_path FROM (
          SELECT revision_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(k, '^\$\[(\d+)\]', 's\1'), '\.sections\[(\d+)\]', '.s\1', 'g'), '\.blocks\[(\d+)\]', '.b\1'), '\.annotations\[(\d+)\]', '.a\1'), '\.turns\[(\d+)\]', '.t\1') AS node_path
          FROM (SELECT revision_id, replace(j.fullkey, '"', '') AS k FROM (SELECT revision_id, sections FROM wiki_pages WHERE json_valid(sections) AND revision_id IS NOT NULL) p, json_tree(p.sections) j WHERE j.type = 'OBJECT')
          WHERE regexp_full_match(k, '\$\[\d+\](\.sections\[\d+\])*(\.blocks\[\d+\](\.(annotations|turns)\[\d+\])?)?'))
        UNION ALL SELECT 'quote', quote_no, 'a' || (i - 1), '' FROM (SELECT quote_no, unnest(annotations) AS e, generate_subscripts(annotations, 1) AS i FROM quotes) WHERE e IS NOT NULL
        UNION ALL SELECT 'quote', quote_no, 'p' || (i - 1), '' FROM (SELECT quote_no, unnest(source.parts) AS e, generate_subscripts(source.parts, 1) AS i FROM quotes) WHERE e IS NOT NULL""",
    "p3_found": """
        SELECT page_title, page_type, count(DISTINCT id) AS n_ids
        FROM quotes WHERE page_title IS NOT NULL GROUP BY page_title, page_type""",
    "p5_found": rf"""
        SELECT quote_no, field FROM (SELECT quote_no, 'source.work_title' AS field, source.work_title AS v FROM quotes UNION ALL SELECT quote_no, 'speaker.name', speaker.name FROM quotes) WHERE v IS NOT NULL AND ({_UNFIT})
        UNION ALL SELECT quote_no, 'source.date_iso' FROM (
          SELECT quote_no, source.date_iso AS d, source.date_precision AS p, year(loaded_at) AS y,
            CASE source.date_precision WHEN 'day' THEN '-?\d{{4}}-\d{{2}}-\d{{2}}' WHEN 'month' THEN '-?\d{{4}}-\d{{2}}' ELSE '-?\d{{4}}' END AS form FROM quotes)
        WHERE d IS NOT NULL AND (NOT regexp_full_match(d, form) OR try_cast(CASE p WHEN 'day' THEN ltrim(d, '-') WHEN 'month' THEN ltrim(d, '-') || '-01' ELSE ltrim(d, '-') || '-01-01' END AS date) IS NULL
          OR try_cast(regexp_extract(d, '^-?(\d{{4}})', 1) AS int) = 0 OR (NOT starts_with(d, '-') AND try_cast(left(d, 4) AS int) > y))""",
}
