"""DuckDB equivalents of the queries of the page family."""

from __future__ import annotations

from quillon.functions.text import STOP_WORDS

_B = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_P = "p AS (SELECT * FROM page QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1)"
_T = f"""{_P},
  titles AS (
    SELECT title, id, nullif(redirect, '') AS redirect, coalesce(disambiguation, false) AS disambiguation FROM p
    WHERE title IS NOT NULL AND id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY title ORDER BY CAST(id AS HUGEINT), id) = 1),
  valid AS (SELECT r.title, r.redirect AS target FROM titles r WHERE r.redirect IN (SELECT title FROM titles))"""
_ID2 = f"""{_T},
  id2title AS (
    SELECT t.id, coalesce(x.id, t.id) AS target_id, coalesce(v.target, t.title) AS target_title
    FROM titles t LEFT JOIN valid v ON v.title = t.title LEFT JOIN titles x ON x.title = coalesce(v.target, t.title))"""
_L = f"""{_P},
  links AS (
    SELECT page_id, page_title, pos, l.text AS text, l.start_pos AS start_pos, l.end_pos AS end_pos, l.title AS title, l.id AS id FROM (
      SELECT id AS page_id, title AS page_title, unnest(links) AS l, CAST(generate_subscripts(links, 1) - 1 AS INT) AS pos FROM p))"""
_E = f"{_L}, e AS (SELECT DISTINCT page_title AS src, title AS dst FROM links WHERE id <> '' AND title IS NOT NULL AND page_title IS NOT NULL)"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_OK = "id <> '' AND title <> '' AND NOT regexp_matches(title, '^(File|Image):')"


def _mentions(where: str = _OK) -> str:
    return f"""{_L},
      s AS (
        SELECT title, regexp_replace(translate(regexp_replace(lower(regexp_replace(text, '[\\t\\n\\r]', ' ', 'g')), '^{_B}+|{_B}+$', '', 'g'), '\\', ''), '{_B}+', ' ', 'g') AS s
        FROM links WHERE text IS NOT NULL AND {where}),
      forms AS (
        SELECT title, unnest(list_distinct([s,
          trim(regexp_replace(regexp_replace(s, ' \\([^)]*\\)|<[^)]*>|[,".'':-]', '', 'g'), '\\s+', ' ', 'g')),
          array_to_string(list_filter(regexp_split_to_array(s, '{_B}+'), lambda w: NOT list_contains([{_STOP}], w)), ' ')])) AS mention FROM s),
      counts AS (SELECT mention, title, count(*) AS n FROM forms WHERE length(mention) > 0 GROUP BY 1, 2)"""


def _titles_of(expr: str) -> str:
    return f"WITH {_P} SELECT id, {expr} AS text FROM p WHERE title IS NOT NULL"


def _norm(x: str) -> str:
    t = f"regexp_replace(translate({x}, '_', ' '), '^{_B}+|{_B}+$', '', 'g')"
    return f"upper(left({t}, 1)) || substr({t}, 2)"


_SENTENCES = f"""{_P},
  a AS (SELECT * FROM annotated QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1),
  s AS (
    SELECT a.id, n, s.start_pos AS start_pos, s.end_pos AS end_pos, links FROM (
      SELECT id, unnest(sentences) AS s, CAST(generate_subscripts(sentences, 1) - 1 AS INT) AS n FROM a) a JOIN p ON p.id = a.id),
  k AS (SELECT id, n, start_pos, end_pos, list_filter(coalesce(links, []), lambda x: x.start_pos >= start_pos AND x.end_pos <= end_pos) AS ls FROM s)"""
_RAW = f"""{_ID2},
  raw AS (SELECT id AS ll_from, lang AS ll_lang, replace(title, ' ', '_') || '\\''' AS ll_title FROM p WHERE title IS NOT NULL AND lang IS NOT NULL),
  ll AS (
    SELECT ll_lang AS lang, translate(ll_title, '_\\', ' ') AS title, translate(target_title, '_\\', ' ') AS title_ll, target_id AS id_ll
    FROM raw JOIN id2title ON id2title.id = raw.ll_from)"""


def oracle_sql() -> dict[str, str]:
    resolved = f"""{_T}, {_L[len(_P) + 1:]},
      moved AS (
        SELECT l.page_id, l.pos, coalesce(v.target, l.title) AS title FROM links l LEFT JOIN valid v ON v.title = l.title)"""
    return {
        "titles_dedup": f"WITH {_T} SELECT title, id, redirect, disambiguation FROM titles",
        "redirects_valid": f"WITH {_T} SELECT title, target FROM valid",
        "redirects_dangling": f"WITH {_T} SELECT title, redirect AS target FROM titles WHERE redirect IS NOT NULL AND redirect NOT IN (SELECT title FROM titles)",
        "redirects_two_hops": f"WITH {_T} SELECT v.title, coalesce(w.target, v.target) AS target, CASE WHEN w.target IS NULL THEN 1 ELSE 2 END AS hops FROM valid v LEFT JOIN valid w ON w.title = v.target",
        "id2title": f"WITH {_ID2} SELECT * FROM id2title",
        "articles": f"WITH {_T} SELECT id, title FROM titles WHERE NOT disambiguation AND title NOT IN (SELECT title FROM valid)",
        "disambiguations": f"WITH {_T} SELECT title FROM titles WHERE disambiguation",
        "links_resolved": f"WITH {resolved} SELECT m.page_id, m.pos, m.title, t.id FROM moved m LEFT JOIN titles t ON t.title = m.title",
        "links_regrouped": f"WITH {resolved} SELECT page_id, count(*) AS n, string_agg(coalesce(title, ''), '|' ORDER BY pos) AS titles FROM moved GROUP BY page_id",
        "page_links": f"WITH {_L} SELECT page_id, pos, text, start_pos, end_pos, title, id FROM links",
        "page_sections": f"WITH {_P} SELECT page_id, pos, s.text AS text, s.start_pos AS start_pos, s.end_pos AS end_pos, s.title AS title, s.level AS level FROM (SELECT id AS page_id, unnest(sections) AS s, CAST(generate_subscripts(sections, 1) - 1 AS INT) AS pos FROM p)",
        "link_counters": f"WITH {_L} SELECT count(*) AS num_of_links, count(*) FILTER (id IS NULL OR id = '') AS num_of_invalid_title FROM links",
        "outlinks": f"WITH {_E} SELECT src AS title, dst AS target FROM e",
        "inlinks": f"WITH {_E} SELECT dst AS title, src AS source FROM e",
        "edge_degrees": "WITH e AS (SELECT DISTINCT src, dst FROM edge WHERE src IS NOT NULL AND dst IS NOT NULL) SELECT title, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) AS BIGINT) AS n_in FROM (SELECT src AS title, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) GROUP BY title",
        "page_categories": f"WITH {_P} SELECT DISTINCT title, category FROM (SELECT title, unnest(categories) AS category FROM p WHERE title IS NOT NULL) WHERE category IS NOT NULL",
        "mention_counts": f"WITH {_mentions()} SELECT * FROM counts",
        "mention_counts_raw": f"WITH {_L} SELECT text AS mention, title, count(*) AS n FROM links WHERE length(text) > 0 AND {_OK} GROUP BY 1, 2",
        "mention_threshold": f"WITH {_mentions()} SELECT * FROM counts WHERE n > 2",
        "mention_allow_list": f"WITH {_mentions(_OK + ' AND id IN (SELECT id FROM article)')} SELECT * FROM counts",
        "mention_to_entity": f"WITH {_mentions()} SELECT mention, title, n, round(n / sum(n) OVER (PARTITION BY mention), 9) AS p FROM counts",
        "entity_to_mention": f"WITH {_mentions()} SELECT mention, title, n, round(n / sum(n) OVER (PARTITION BY title), 9) AS p FROM counts",
        "entity_prior": f"WITH {_mentions()} SELECT title, round(sum(n) / (SELECT sum(n) FROM counts), 9) AS p FROM counts GROUP BY title",
        "titles_normalized": f"""SELECT title, {_norm("(' _' || translate(lower(left(title, 1)) || substr(title, 2), ' ', '_') || '_ ')")} AS normal, translate(title || '_\\''x', '_\\', ' ') AS langlink,
            'http://wiki.example/?curid=' || length(title) AS url, upper(left(title, 1)) || substr(title, 2) AS upper, lower(left(title, 1)) || substr(title, 2) AS lower
            FROM (SELECT DISTINCT title FROM page WHERE title IS NOT NULL)""",
        "namespace_titles": "SELECT title, 'Talk:' || upper(left(t, 1)) || substr(t, 2) AS \"full\" FROM (SELECT title, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t FROM (SELECT DISTINCT title FROM page WHERE title IS NOT NULL))",
        "category_markup": f"WITH {_P} SELECT id, array_to_string([trim(c) for c in categories if length(c) > 0], '|') AS names FROM p WHERE len(categories) > 0",
        "section_marks": f"WITH {_P} SELECT id, '==A==|=== ' || title || ' ===' AS marks FROM p WHERE title IS NOT NULL",
        "disambiguation_flag": f"WITH {_P} SELECT id, length(title) % 4 <> 3 AND coalesce(redirect, '') = '' AS flag FROM p WHERE title IS NOT NULL",
        "main_namespace": f"WITH {_P} SELECT id FROM p WHERE length(title) % 3 = 0",
        "parsed_articles": f"""WITH {_P} SELECT id, title || ' is a thing of Site. ' || chr(10) || '==Part==' || chr(10) || 'Body bold & end.' AS article, '{{{{Infobox a|{{{{b}}}}}}}}' AS infobox, CAST(1 AS BIGINT) AS n_links,
            'thing' AS link_text, CAST(length(title) + 6 AS INT) AS link_start, {_norm('lower(title)')} AS link_title, 'http://x.example/a' AS url, CAST(length(title) + 15 AS INT) AS url_start,
            'Part' AS section, CAST(2 AS INT) AS level, trim(title) AS categories, true AS fine FROM p WHERE title IS NOT NULL""",
        "clean_templates": _titles_of("'a ' || title || ' b }} c'"),
        "clean_quotes": _titles_of("title || ' and \"' || title || '\"'"),
        "clean_tags": _titles_of("'AB' || title || 'goneC' || chr(160) || 'D'"),
        "clean_formulas": _titles_of("'formula_1 formula_2, x....'"),
        "compact_sections": _titles_of("'==' || trim(title) || '==' || chr(10) || '===B===' || chr(10) || 'text' || chr(10) || ' ind'"),
        "expand_templates": _titles_of("'<' || title || '-d> ' || upper(trim(title)) || ' 7 '"),
        "strip_markup": _titles_of("title || ' b' || chr(10) || 'cap.'"),
        "zh_sentences": _titles_of("title || '。|' || title || '！|丙'"),
        "title_tokens": f"""SELECT title, array_to_string(list_filter(regexp_split_to_array(translate(regexp_replace(translate(title, 'ʼ’‘´′''', chr(57344)||chr(57345)||chr(57346)||chr(57347)||chr(57348)||chr(57349)), '([\\p{{P}}\\p{{S}}።፡])', ' \\1 ', 'g'),
            chr(57344)||chr(57345)||chr(57346)||chr(57347)||chr(57348)||chr(57349), 'ʼ’‘´′'''), '{_B}+'), lambda w: w <> ''), '|') AS tokens FROM (SELECT DISTINCT title FROM page WHERE title IS NOT NULL)""",
        "sentence_rows": f"""WITH {_SENTENCES} SELECT id || '_' || n AS _id, id, end_pos - start_pos AS len_char, CAST(len(ls) AS INT) AS len_links,
            array_to_string([coalesce(lower(x.text), '') || ':' || (x.start_pos - start_pos) for x in ls], '|') AS links FROM k""",
        "sentence_langlinks": f"""WITH {_SENTENCES}, {_T[len(_P) + 1:]}, flat AS (SELECT id, n, unnest(ls).title AS title FROM k),
            hits AS (SELECT f.id, f.n, count(*) AS all_n, count(t.id) AS ll FROM flat f LEFT JOIN titles t ON t.title = f.title GROUP BY 1, 2)
            SELECT k.id, k.n, coalesce(all_n, 0) AS len_links, coalesce(ll, 0) AS len_links_ll FROM k LEFT JOIN hits h ON h.id = k.id AND h.n = k.n""",
        "sentence_full_rows": f"""WITH {_SENTENCES}, {_T[len(_P) + 1:]}, flat AS (SELECT id, n, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM k),
            hits AS (SELECT f.id, f.n, count(*) AS all_n, count(t.id) AS ll, string_agg(coalesce(lower(x.text), '') || ':' || coalesce(t.id, '-'), '|' ORDER BY i) AS links
                FROM flat f LEFT JOIN titles t ON t.title = f.x.title GROUP BY 1, 2)
            SELECT k.id || '_' || k.n AS _id, k.id, p.title, t.id AS id_ll, end_pos - start_pos AS len_char, CAST(coalesce(all_n, 0) AS INT) AS len_links, CAST(coalesce(ll, 0) AS INT) AS len_links_ll,
                coalesce(h.links, '') AS links
            FROM k JOIN p ON p.id = k.id LEFT JOIN titles t ON t.title = p.title LEFT JOIN hits h ON h.id = k.id AND h.n = k.n""",
        "links_unmatched": f"""WITH {_P}, a AS (SELECT * FROM annotated QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1),
            l AS (SELECT DISTINCT p.id, x.start_pos, x.end_pos, a.sentences AS s FROM (SELECT id, unnest(links) AS x FROM p) p JOIN a ON a.id = p.id WHERE x.start_pos IS NOT NULL AND x.end_pos IS NOT NULL)
            SELECT id, start_pos, end_pos FROM l WHERE s IS NULL OR len(list_filter(s, lambda y: start_pos >= y.start_pos AND end_pos <= y.end_pos)) = 0""",
        "langlinks_attached": f"WITH {_RAW} SELECT * FROM ll",
        "langlinks_rejected": f"WITH {_RAW} SELECT ll_lang, ll_title FROM raw WHERE ll_from NOT IN (SELECT id FROM id2title)",
        "langlinks_dedup": f"WITH {_RAW} SELECT lang, title, min({{'i': id_ll, 't': title_ll}}).t AS title_ll, min(id_ll) AS id_ll, count(*) AS n FROM ll GROUP BY lang, title",
        "chunk_plan": """WITH s AS (SELECT o, row_number() OVER (ORDER BY o) - 1 AS n FROM (SELECT DISTINCT CAST(length(title) * 7 + ascii(title) * 1000 AS BIGINT) AS o FROM page WHERE title IS NOT NULL))
            SELECT o AS beg, lead(o, 1, -1) OVER (ORDER BY o) AS "end" FROM s WHERE n % 100 = 0""",
    }
