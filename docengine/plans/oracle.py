"""Oracle SQL per query, written with joins, windows and recursion over plain tables.

The statements take other ways than the Spark expressions: lines and words are
unnested, islands are found with window functions, chunks by recursion.
"""

from docengine.functions.fixed_values import (
    DESCRIPTION_FIELD,
    NULL_TOKENS,
    PROMPTS,
    THREAT_FIELD,
)

WS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WS_CHARS = "||".join(f"chr({c})" for c in range(0x3001) if chr(c).isspace())
BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
NL = "chr(10)"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"trim({e}, {WS_CHARS})"


def render(template: str, **values: str) -> str:
    """Nested replace; the values never hold a place holder themselves."""
    out = quote(template)
    for name, value in values.items():
        out = f"replace({out}, '{{{name}}}', {value})"
    return out


def normalized(e: str) -> str:
    one = strip(f"regexp_replace({e}, '{WS}+', ' ', 'g')")
    return f"coalesce(nullif(regexp_extract({one}, '(?s)^(.*\\p{{L}})', 1), ''), {one})"


# Lines of documents with their words, and the headings made of them.
LINES = f"""
doc_lines as (
  select doc_id, line, n,
         list_filter(regexp_split_to_array(line, '{WS}+'), lambda w: w <> '') as words
  from documents, unnest(string_split(text, {NL})) with ordinality u(line, n)
),
headed as (
  select doc_id, line, n, words,
         case when len(words) >= 3 then n || '. ' || array_to_string(words[1:3], ' ') end as title
  from doc_lines
)"""

REPORTS = LINES + f""",
toc_parts as (
  select doc_id, n, title, row_number() over (partition by doc_id order by n) - 1 as j
  from headed where title is not null
),
toc_texts as (
  select doc_id, string_agg(
    case when j % 10 = 9 then chr(12) else '' end || title || ' '
    || repeat('.', 5 + (n % 7)::int) || ' ' || n
    || case when j % 4 = 3 then {NL} || {NL} || 'continued' else '' end
    || case when j = 2 and doc_id % 13 = 5 then repeat({NL} || 'stray', 11) else '' end,
    {NL} order by j) as toc
  from toc_parts group by doc_id
),
bodies as (
  select doc_id, string_agg(coalesce(title || {NL}, '') || line, {NL} order by n) as body
  from headed group by doc_id
),
reports as (
  select d.doc_id, 'doc_' || d.doc_id as doc_key,
    case when toc is null then d.text
    else 'Report ' || d.doc_id || {NL} || 'Sisukord' || {NL} || toc || {NL} || {NL} || body
    end as text
  from documents d join bodies using (doc_id) left join toc_texts using (doc_id)
)"""

TOC = REPORTS + f""",
report_lines as (
  select doc_id, line, n
  from reports, unnest(regexp_split_to_array(text, '{BREAK}')) with ordinality u(line, n)
),
marker as (
  select doc_id, min(n) as m from report_lines where contains(line, 'Sisukord') group by doc_id
),
filled as (
  select doc_id, m, n, line,
         row_number() over (partition by doc_id order by n) - 1 as ord,
         regexp_matches(line, '\\.{{5,}}{WS}*\\p{{Nd}}+$') as hit
  from report_lines join marker using (doc_id)
  where n >= m and {strip('line')} <> ''
),
gaps as (
  select *, ord - lag(ord, 1, -1) over (partition by doc_id order by ord) - 1 > 10 as far
  from filled where hit
),
kept as (
  select *, max(far) over (partition by doc_id order by ord) as dead from gaps
),
toc as (
  select doc_id, m, n, line as raw, {normalized('line')} as title,
         row_number() over (partition by doc_id order by n) - 1 as k
  from kept where not dead
)"""

SLICES = TOC + f""",
bounds as (select doc_id, min(m) as first, max(n) as last from toc group by doc_id),
cut_bodies as (
  select doc_id, lower(string_agg(line, {NL} order by n)) as body
  from report_lines join bounds using (doc_id)
  where n < first or n > last group by doc_id
),
entries as (
  select doc_id, k, title, lower(title) as t,
         lower(lead(title) over (partition by doc_id order by k)) as nxt
  from toc
),
tails as (
  select doc_id, k, title, nxt, substr(body, strpos(body, t)) as tail
  from entries join cut_bodies using (doc_id) where strpos(body, t) > 0
),
slices as (
  select doc_id, k, title,
    {strip("case when nxt <> '' and strpos(tail, nxt) > 0 then substr(tail, 1, strpos(tail, nxt) - 1) else tail end")} as section_text
  from tails
)"""

# Mentions of a document's first word in three candidate documents.
MENTIONS = f"""
entities as (
  select doc_id as species_id, regexp_extract(text, '\\p{{L}}+') as name,
         [doc_id + 1, doc_id // 2, doc_id + 7] as ids
  from documents
),
pairs as (
  select species_id, name, id, i - 1 as pos
  from entities, unnest(ids) with ordinality u(id, i) where name <> ''
),
mentions as (
  select species_id, pos, id, len(regexp_extract_all(text, '(?i)' || regexp_escape(name))) as n
  from pairs join documents d on d.doc_id = id
)"""

LAW = """
law as (
  select page_id, url, regexp_extract(url, '/\\w\\w/(\\d+)', 1) as number,
         case when contains(html, '<html lang="en">') then 0
              when contains(html, '<html lang="fr">') then 1 else 2 end as section,
         regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a></li>', 1) as latin,
         regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a></li>', 2) as names
  from pages
),
species as (
  select page_id, section, (i - 1)::int as pos, number,
         page_id || '-' || section || '-' || (i - 1) as species_id, name,
         trim(regexp_replace(latin[i], '[;,.]*$', '')) as latin,
         ['I', 'II', 'III'][section + 1] as category
  from law, unnest(names) with ordinality u(name, i)
)"""

# Registry page values: the last shown value of each key.
PROFILES = LAW + """,
kv as (
  select species_id, page_id, number, pos, name, latin, category,
    case when category = 'III' then 'Imetajad' else 'Linnud' end as grp,
    case when pos = 5 then 'later' else '' end as description,
    case when pos % 5 = 0 then 'NA' else 'low' end as threats,
    case when pos % 3 = 1 then ['doc_' || number || '.pdf', 'doc_' || page_id || '.pdf']
         else [] end as files
  from species
)"""

ROUTED = f"""
toc_docs as (
  select 'doc_' || doc_id as doc_key, {strip(f"string_agg(raw, {NL} order by k)")} as toc_text
  from toc group by doc_id
),
routed as (
  select e.*, r.text, t.toc_text,
    case when r.text is null then null
      when in_file and t.toc_text is not null then 'TOC_SINGLE'
      when in_file then 'WHOLE_TEXT'
      when t.toc_text is not null and contains(lower(t.toc_text), lower(stem)) then 'TOC_MULTI'
      when t.toc_text is not null and present then 'TOC_SINGLE'
      else 'SNIPPETS' end as route
  from (select *, substr(name, 1, greatest(length(name) - 2, 0)) as stem,
               coalesce(contains(lower(file), lower(stem)), false) as in_file from to_route) e
  left join reports r on r.doc_key = e.doc_key
  left join toc_docs t on t.doc_key = e.doc_key
)"""


def snippets(k: int) -> str:
    """Distinct lines near a line with the stem, in order, per routed entity."""
    return f"""
text_lines as (
  select species_id, stem, line, i
  from routed, unnest(string_split(text, {NL})) with ordinality u(line, i)
  where route = 'SNIPPETS'
),
near_lines as (
  select species_id, line, min(i) as i from (
    select *, max(contains(line, stem)) over (
      partition by species_id order by i rows between {k} preceding and {k} following) as near
    from text_lines) where near group by species_id, line
),
snippets as (
  select species_id, string_agg(line, {NL} order by i) as snippet
  from near_lines group by species_id
)"""


def chunks(source: str, key: str, text: str, limit: int) -> str:
    """Greedy chunks: each start leads to the next one, followed by recursion."""
    return f"""
words as (
  select {key}, w, i, sum(length(w)) over (partition by {key} order by i) as upto
  from (select {key}, w, row_number() over (partition by {key} order by o) as i
        from {source}, unnest(regexp_split_to_array({text}, '{WS}+')) with ordinality u(w, o)
        where w <> '')
),
heads as (
  select a.{key}, a.i, a.i = 1 and length(a.w) > {limit} as oversized,
         case when b.i is null then null else greatest(b.i, a.i + 1) end as nxt
  from words a asof left join words b
    on a.{key} = b.{key} and a.upto - length(a.w) + {limit} < b.upto
),
starts as (
  with recursive s as (
    select {key}, i, nxt, oversized, 0 as c from heads where i = 1
    union all
    select h.{key}, h.i, h.nxt, s.oversized, s.c + 1
    from s join heads h on h.{key} = s.{key} and h.i = s.nxt)
  select {key}, i, nxt, c + oversized::int as chunk, oversized from s
),
chunks as (
  select s.{key}, s.chunk::int as chunk, string_agg(w.w, ' ' order by w.i) as chunk_text
  from starts s join words w
    on w.{key} = s.{key} and w.i >= s.i and (s.nxt is null or w.i < s.nxt)
  group by all
  union all
  select {key}, 0, '' from starts where oversized and chunk = 1
)"""


def section_prompts(route: str, name: str, toc: str) -> str:
    return (
        f"case {route} when 'TOC_MULTI' then "
        + render(PROMPTS["topics_multi"], name=name, toc=toc)
        + " else "
        + render(PROMPTS["topics_single"], toc=toc)
        + " end"
    )


BUNDLES = f"""
bundles as (
  select conv_id || '-' || turn as species_id, role = 'user' as by_sections,
         text as whole_text,
         text || ' ' || '' || ' ' || case when turn > 1 then role else '' end as bundle_0,
         role || ' ' || reverse(text) as bundle_1
  from conversations
),
summary_requests as (
  select species_id, 'section' as kind, 0 as chunk,
         {render(PROMPTS["section"], field=quote(DESCRIPTION_FIELD), text="bundle_0")} as prompt
  from bundles where by_sections
  union all
  select species_id, 'section', 1,
         {render(PROMPTS["section"], field=quote(THREAT_FIELD), text="bundle_1")}
  from bundles where by_sections
  union all
  select species_id, 'summary', 0, {render(PROMPTS["summary"], text="whole_text")}
  from bundles where not by_sections
)"""

PAGE_TEXT = "replace({0}, chr(10), ' ')"
TURN_TEXT = "translate(text, '\"' || chr(10) || '\\', '   ')"

ORACLE = {
    "synth_reports": f"with {REPORTS} select doc_id, text from reports",
    "toc_scan": f"with {TOC} select doc_id, k::int as k, n::int as line, title from toc",
    "toc_bounds": f"""with {TOC}
        select d.doc_id, min(m)::int as first_line, max(n)::int as last_line,
               case when count(n) > 0 then count(n)::int end as entries
        from documents d left join toc using (doc_id) group by d.doc_id""",
    "section_slices": f"""with {SLICES}
        select doc_id, k::int as k, title, section_text from slices where section_text <> ''""",
    "section_match": f"""with {TOC},
        asked as (
          select distinct doc_id,
                 array_to_string(list_concat([n::varchar], words[1:2]), ' ') as section
          from doc_lines),
        keyed as (select *, lower(replace({normalized('section')}, '.', '')) as key from asked
                  where {strip('section')} <> '')
        select doc_id, section, min(k)::int as k, arg_min(title, k) as title
        from keyed join toc using (doc_id)
        where contains(lower(replace(title, '.', '')), key)
        group by doc_id, section""",
    "normalized_lines": f"""with {LINES}
        select doc_id, (n - 1)::int as i,
               {normalized("chr(9) || ' ' || line || ' ..... ' || (n - 1)")} as normalized
        from doc_lines""",
    "topic_texts": f"""with {SLICES},
        body_lines as (
          select doc_id, title as line, row_number() over (partition by doc_id order by n) - 1 as h
          from headed where title is not null),
        wanted as (
          select distinct doc_id, line, lower(replace({normalized('line')}, '.', '')) as key
          from body_lines),
        matched as (
          select w.doc_id, w.line, min(k) as k from wanted w join toc using (doc_id)
          where contains(lower(replace(title, '.', '')), key) group by all),
        texts as (
          select b.doc_id, h, section_text from body_lines b
          join matched m using (doc_id, line) join slices using (doc_id, k)
          where section_text <> '')
        select d.doc_id as species_id, {', '.join(
            f"coalesce(string_agg(section_text, {NL} order by h) filter (h % 7 = {t}), '') as text_{t}"
            for t in range(7))}
        from documents d left join texts using (doc_id) group by d.doc_id""",
    "context_lines": f"""with lines as (
          select doc_id, line, i from documents, unnest(string_split(text, {NL})) with ordinality u(line, i)),
        near as (
          select *, max(contains(line, 'tion')) over (
            partition by doc_id order by i rows between 2 preceding and 2 following) as near from lines),
        firsts as (select doc_id, line, min(i) as i from near where near group by doc_id, line)
        select d.doc_id, coalesce(string_agg(line, {NL} order by i), '') as text
        from documents d left join firsts using (doc_id) group by d.doc_id""",
    "chunk_greedy": f"with {chunks('documents', 'doc_id', 'text', 500)} select * from chunks",
    "mention_counts": f"""with {MENTIONS}
        select species_id, pos::int as pos, n::int as n from mentions""",
    "best_document": f"""with {MENTIONS},
        best as (select species_id, arg_max(id, n * 10 - pos) filter (n > 0) as id
                 from mentions group by species_id)
        select e.species_id, name as "Estonian Name",
          case when name = ''
               then array_to_string(list_transform(ids, lambda x: 'strategy_materials/doc_' || x || '.pdf'), ',')
               else coalesce('doc_' || id || '.pdf', 'Not Present') end as strategy_file
        from entities e left join best using (species_id)""",
    "unprocessed_documents": """select doc_id, source from documents d
        where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "assemble_documents": """select conv_id as doc_id,
          bool_and(role <> 'assistant' or text = '') as scanned,
          case when bool_and(role <> 'assistant' or text = '') then string_agg(text, '' order by turn)
               else coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '') end as text
        from conversations group by conv_id""",
    "scanned_documents": """select d.doc_id,
          coalesce(bool_and(role <> 'assistant' or c.text = ''), true) as scanned
        from documents d left join conversations c on c.conv_id = d.doc_id group by d.doc_id""",
    "cleaned_documents": f"""with flags as (
          select conv_id, bool_and(role <> 'assistant' or text = '') as scanned,
                 string_agg(text, {NL} order by turn) as ocr,
                 string_agg(case when role = 'assistant' then text else '' end, {NL} order by turn) as native
          from conversations
          where conv_id not in (select doc_id from labels where toxic = 1) group by conv_id)
        select conv_id as doc_id, scanned,
          case when scanned then coalesce({strip('d.text')}, ocr) else native end as text
        from flags left join documents d on d.doc_id = conv_id""",
    "scan_over_native": """select coalesce(d.doc_id, b.item_id) as doc_id, coalesce(b.text, d.text) as text
        from documents d full join benchmark b on d.doc_id = b.item_id""",
    "html_rows": """select page_id, (i - 1)::int as pos, cell
        from (select page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1),
                                                 '<li><a[^>]*>([^<]*)</a></li>', 1) as cells from pages),
             unnest(cells) with ordinality u(cell, i)""",
    "species_list": f"""with {LAW}
        select page_id, section, pos, name, latin, category from species""",
    "clean_names": """select p_partkey, p_name as name, p_name || ' (' || p_type || ')' as latin from part""",
    "registry_union": f"""with found as (
          select page_id, 'I' as category, unnest(regexp_extract_all(html, '(?s)<title>(.*?)</title>', 1)) as b from pages
          union all
          select page_id, 'II', unnest(regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)) from pages
          union all
          select page_id, 'III', unnest(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1)) from pages)
        select page_id, category, replace({strip('''replace(replace(replace(replace(
            regexp_replace(b, '<[^>]*>', '', 'g'),
            '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')''')}, chr(10), ' ') as name
        from found""",
    "lookup_links": """with hits as (
          select case c_custkey % 3 when 0 then c_name || ' (' || c_mktsegment || ')'
                 when 1 then c_name else n_name end as name,
                 c_custkey as pos, n_name || '/' || c_custkey as link
          from customer join nation on c_nationkey = n_nationkey),
        first as (select name, arg_min(link, pos) as link from hits group by name)
        select c_custkey as species_id, coalesce(a.link, b.link, 'NotFound') as link
        from customer
        left join first a on a.name = c_name || ' (' || c_mktsegment || ')'
        left join first b on b.name = c_name""",
    "kv_pivot": """select user_id as species_id, {}, null::varchar as absent
        from events group by user_id""".format(
        ", ".join(
            f"arg_max(props, {{'t': ts, 'e': event_id}}) filter (event_type = '{t}') as {t}"
            for t in ["view", "click", "purchase", "signup", "error"]
        )
    ),
    "page_key_values": f"""with {PROFILES}
        select species_id, r.pos::int as pos, r.name, r.value from kv,
          unnest([
            {{'pos': 1, 'name': 'Nimi ladina k', 'value': '-'}},
            {{'pos': 2, 'name': 'Nimi inglise k', 'value': latin}},
            {{'pos': 3, 'name': 'Rühm', 'value': grp}},
            {{'pos': 4, 'name': 'Kaitsekategooria', 'value': category}},
            {{'pos': 5, 'name': 'Kirjeldus', 'value': case when kv.pos % 2 = 0 then '' else 'on & off' end}},
            {{'pos': 6, 'name': 'Ohutegurite kirjeldus', 'value': threats}},
            {{'pos': 7, 'name': 'Liigi tegevuskava', 'value':
               case when kv.pos % 3 = 1 then 'doc_' || number || '  nodoc_' || page_id else '-' end}},
            {{'pos': 8, 'name': 'Kirjeldus', 'value': description}}]) u(r)""",
    "plan_files": f"""with {PROFILES}
        select species_id, array_to_string(files, '; ') as files from kv""",
    "enrich_filter_project": """select c_custkey as species_id, c_name as link, false as strategy_present,
          n_name as kind, r_name as grp,
          case when c_custkey % 4 = 0 then n_name else c_mktsegment end as description,
          null::varchar as english
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey
        where r_name = 'EUROPE' and c_custkey % 10 <> 0""",
    "top3_candidates": """with found as (
          select regexp_extract(url, '/(\\w\\w)/\\d+', 1) as lang, url, min(page_id) as r
          from pages where lower(url) like '%.html' group by all)
        select lang, place::int as place, url from (
          select lang, url, row_number() over (partition by lang order by r, url) as place from found)
        where place <= 3""",
    "backfill_candidates": """with found as (
          select regexp_extract(url, '/\\w\\w/(\\d+)', 1)::bigint as doc_id, url || '.pdf' as url, min(page_id) as r
          from pages group by all),
        files as (
          select doc_id, string_agg(string_split(url, '/')[-1], ',' order by r, url) as files from (
            select *, row_number() over (partition by doc_id order by r, url) as place from found)
          where place <= 3 group by doc_id)
        select d.doc_id as species_id, l.doc_id is not null or files is not null as strategy_present,
               case when l.doc_id is not null then 'own.pdf' else files end as strategy_file
        from documents d left join labels l on l.doc_id = d.doc_id left join files f on f.doc_id = d.doc_id""",
    "search_queries": """select s_suppkey as species_id,
          '"kaitse tegevuskava" "' || s_name || '" pdf' as query
        from supplier where s_acctbal <= 5000""",
    "file_names": """with u as (
          select page_id, url, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] as base from pages)
        select page_id, base || '.Pdf' as file, base as doc_key, base || '_cleaned.txt' as text_file,
               true as is_pdf, left(url, length(url) - 2) as stem, url || '|' || page_id as listed from u""",
    "needs_enrichment": """select d.doc_id, source from documents d left join labels l using (doc_id)
        where quality is distinct from 1 or toxic is distinct from 0""",
    "combine_responses": f"""select conv_id as species_id,
          {strip(f"string_agg(' ' || text || ' ', {NL} order by turn)")} as text
        from conversations where role <> 'system' group by conv_id""",
    "parse_responses": f"""with t as (select conv_id, turn, role, (conv_id + turn) % 9 as shape, {TURN_TEXT} as text from conversations)
        select conv_id, turn,
          case when shape in (0, 1, 6) then text when shape = 4 then turn::varchar else 'NA' end as "Desc",
          case when shape in (0, 1, 6) then 'a, ' || role when shape = 4 then 'true' else 'NA' end as "Threat"
        from t""",
    "parse_topics": f"""select conv_id * 1000 + turn as species_id, null::varchar as topic_0, null::varchar as topic_1,
          {TURN_TEXT} || ', 2 B' as topic_2, null::varchar as topic_3, role as topic_4,
          null::varchar as topic_5, null::varchar as topic_6
        from conversations""",
    "requested_sections": f"""with {LINES},
        body_lines as (
          select doc_id, title, row_number() over (partition by doc_id order by n) - 1 as h
          from headed where title is not null)
        select doc_id as species_id, 'doc_' || doc_id as doc_key, (h % 7)::int as topic,
               (h // 7)::int as pos, title as section from body_lines""",
    "bundle_topics": f"with {BUNDLES} select * from bundles",
    "summary_requests": f"""with {BUNDLES}
        select species_id, kind, chunk, md5(prompt) as prompt from summary_requests""",
    "clean_requests": f"""with scans as (
          select conv_id, string_agg(text, '' order by turn) as text from conversations
          group by conv_id having bool_and(conv_id % 3 = 0 or role <> 'assistant' or text = ''))
        select conv_id as doc_id, md5({render(PROMPTS["clean"], text="text")}) as prompt from scans""",
    "merge_responses": f"""with {BUNDLES},
        answers as (select species_id, kind, chunk, md5(prompt) as d from summary_requests
                    where species_id not like '%-3')
        select b.species_id,
          coalesce(case when by_sections then 'S ' || s0.d else 'D ' || w.d end, 'NA') as field_0,
          coalesce(case when by_sections then 'S ' || s1.d else 'T, ' || w.d end, 'NA') as field_1
        from bundles b
        left join answers s0 on s0.species_id = b.species_id and s0.kind = 'section' and s0.chunk = 0
        left join answers s1 on s1.species_id = b.species_id and s1.kind = 'section' and s1.chunk = 1
        left join answers w on w.species_id = b.species_id and w.kind = 'summary'""",
    "ragged_union": """select doc_id, lang, n_chars, null::int as quality, null::int as toxic from documents
        union all select doc_id, null, null, quality, toxic from labels
        union all select item_id, null, length(text), null, null from benchmark""",
    "null_cells": f"""with t as (
          select conv_id, turn, case when role = 'user' then 'NA' else role end as role,
                 case when turn % 4 = 0 then '' else text end as text from conversations),
        u as (select conv_id, turn,
            {", ".join(f"case when {c} not in ({', '.join(quote(x) for x in NULL_TOKENS)}) then {c} end as {c}" for c in ("role", "text"))}
          from t)
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
               role is null as role_is_null from u""",
    "csv_round_trip": """select doc_id, case when lang = 'en' then null else lang end as lang,
          '"' || text as text, n_chars > 1000 as long from documents""",
    "text_files": f"""with files as (
          select conv_id, string_agg(text, {NL} order by turn) as text from conversations group by conv_id)
        select doc_id, case when conv_id is not null then 'conv_' || conv_id || '_cleaned.txt' end as file_name,
               md5(f.text) as digest
        from documents left join files f on conv_id = doc_id""",
    "file_listing": f"""with files as (
          select conv_id, strlen(string_agg(text, {NL} order by turn)) as length
          from conversations where conv_id % 4 <> 3 group by conv_id)
        select true as recursive, 'conv_' || conv_id as doc_key, length from files
        union all select false, 'conv_' || conv_id, length from files where conv_id % 3 = 0""",
}

ROUTING = TOC + "," + LAW + """,
to_route as (
  select species_id, name, pos < 3 as present,
         case when pos = 4 then name else '' end || '/doc_' || d.id || '.pdf' as file,
         'doc_' || d.id as doc_key
  from species, lateral (select case pos % 3 when 0 then number when 1 then page_id::varchar else 'none' end as id) d
),""" + ROUTED

ORACLE["route_documents"] = f"""with {ROUTING}
    select species_id, route, coalesce(route in ('TOC_SINGLE', 'TOC_MULTI'), null) as flag from routed"""

ORACLE["section_requests"] = f"""with {ROUTING}, {snippets(3)}, {chunks('snippets', 'species_id', 'snippet', 2000)}
    select species_id, 'topics' as kind, 0 as chunk, md5({section_prompts('route', 'name', 'toc_text')}) as prompt
    from routed where route in ('TOC_SINGLE', 'TOC_MULTI')
    union all
    select species_id, 'passages', chunk, md5({render(PROMPTS['passages'], name='name', text='chunk_text')})
    from chunks join routed using (species_id)"""

ORACLE["showcase_end_to_end"] = f"""with {SLICES}, {PROFILES},
    index_rows as (
      select case when pos % 3 = 0 then name || ' (' || latin || ')' else name end as name, species_id
      from species where pos % 3 <> 2),
    index_first as (select name, min(species_id) as first from index_rows group by name),
    linked as (
      select kv.*, coalesce('/lnim/' || a.first, '/lnim/' || b.first, 'NotFound') as link
      from kv left join index_first a on a.name = nullif(kv.name, '') || ' (' || nullif(kv.latin, '') || ')'
      left join index_first b on b.name = nullif(kv.name, '')),
    profiled as (
      select species_id, page_id, number, pos, split_part(species_id, '-', 2) as section,
        nullif(name, '') as name, nullif(latin, '') as latin, category, link, grp,
        nullif(description, '') as description, nullif(threats, 'NA') as threats,
        len(files) > 0 as planned, files
      from linked where link <> 'NotFound' and grp = 'Linnud'),
    gathered as (
      select *, planned or pos <> 5 as present,
        case when planned then files when pos <> 5 then
          [f for f in ['doc_' || number || '.PDF', 'doc_' || page_id || '.pdf', 'doc_' || pos || '.pdf']]
        end as all_files
      from profiled),
    file_pairs as (
      select species_id, name, f, i, 'doc_' || regexp_extract(f, 'doc_(\\d+)', 1) as doc_key
      from gathered, unnest(all_files) with ordinality u(f, i)),
    counted as (
      select species_id, f, i, len(regexp_extract_all(r.text, '(?i)' || regexp_escape(name))) as n
      from file_pairs join reports r using (doc_key) where name is not null),
    best as (
      select species_id, arg_max(f, n * 10 - i) filter (n > 0) as f from counted group by species_id),
    chosen as (
      select g.*, case when all_files is null then null when name is null then array_to_string(all_files, ',')
                       else coalesce(f, 'Not Present') end as file
      from gathered g left join best using (species_id)),
    to_route as (
      select *, regexp_replace(string_split(file, '/')[-1], '(?i)\\.pdf$', '') as doc_key
      from chosen where description is null or threats is null),
    {ROUTED}, {snippets(30)},
    passages as (
      select species_id, 'P ' || md5({render(
          PROMPTS['passages'], name='name',
          text=strip(f"regexp_replace(snippet, '{WS}+', ' ', 'g')"))}) as passage
      from snippets join routed using (species_id)
      where {strip('snippet')} <> ''),
    listed as (
      select species_id, doc_key, line, (h - 1) as h
      from routed, unnest(string_split(toc_text, {NL})) with ordinality u(line, h)
      where route in ('TOC_SINGLE', 'TOC_MULTI')),
    asked as (
      select species_id, doc_key, h,
             {strip("regexp_replace(line, '\\.{5,}[^.]*$|[\\f\"\\\\]', '', 'g')")} as section
      from listed),
    names as (
      select distinct doc_key, section, lower(replace({normalized('section')}, '.', '')) as key
      from asked where section <> ''),
    matched as (
      select doc_key, section, min(k) as k
      from names join toc on 'doc_' || toc.doc_id = doc_key
      where contains(lower(replace(title, '.', '')), key) group by all),
    texts as (
      select species_id, h, section_text
      from asked join matched using (doc_key, section)
      join slices on 'doc_' || slices.doc_id = doc_key and slices.k = matched.k
      where section_text <> ''),
    wide as (
      select species_id, {', '.join(
          f"coalesce(string_agg(section_text, {NL} order by h) filter (h % 7 = {t}), '') as t{t}"
          for t in range(7))}
      from texts group by species_id),
    st7 as (
      select r.*, coalesce(route in ('TOC_SINGLE', 'TOC_MULTI'), false) as flag,
        coalesce(case when route = 'WHOLE_TEXT' then text else passage end, '') as whole,
        {', '.join(f"coalesce(t{t}, '') as t{t}" for t in range(7))}
      from routed r left join wide using (species_id) left join passages using (species_id))
    select name, latin, category, link, present as strategy_present, latin as english, grp,
      category as protection,
      case when flag then 'S ' || md5({render(
          PROMPTS['section'], field=quote(DESCRIPTION_FIELD), text="(t0 || ' ' || t3 || ' ' || t5)")})
        else 'D ' || md5({render(PROMPTS['summary'], text='whole')}) end as description,
      case when flag then 'S ' || md5({render(
          PROMPTS['section'], field=quote(THREAT_FIELD), text="(t1 || ' ' || t2)")})
        else 'T, ' || md5({render(PROMPTS['summary'], text='whole')}) end as threats
    from st7"""
