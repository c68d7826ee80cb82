"""DuckDB statements that compute the same results as the registered queries.

They run on the driver's parquet tables, registered as views under their
table names.  Regular expressions are shared with the Spark side (both
dialects accept them); everything else is written independently in SQL.
"""

from __future__ import annotations

from ..functions import text as tx
from . import fixtures as fx

WS_SQL = "||".join(f"chr({ord(c)})" for c in tx.WS_CHARS)
LF2 = "chr(10)||chr(10)"


def ws_trim(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


# The article fixture exactly as documented in FIXTURES.md section 2.
ARTICLES = f"""
select doc_id as pos,
  concat('{fx.LINK_PREFIX}', doc_id - case when doc_id % 50 = 49 then 1 else 0 end) as link,
  concat('Title ', doc_id) as title,
  case when doc_id % 17 = 0 then 'timeout' when doc_id % 53 = 0 then '' end as error,
  case when doc_id % 17 = 0 or doc_id % 53 = 0 then null
       when doc_id % 29 = 0 then ''
       when doc_id % 4 = 0 then concat('# Title ', doc_id, chr(10), chr(10), 'Published May ', 1 + doc_id % 28,
            ', 2024 Update on GitHub', chr(10), text, chr(10), chr(10), chr(10), chr(10),
            '**b**  __c__ snake_case_x ', chr(9), chr(10), '* i', chr(10), '* j  ')
       when doc_id % 4 = 1 then concat('T', chr(10), 'Published  2024-01-0', 1 + doc_id % 9, chr(10), chr(10), text)
       when doc_id % 4 = 2 then concat('Published x', chr(10), text)
       else text end as text
from documents
"""


def date_sql(col: str) -> str:
    return ws_trim(f"regexp_extract({col}, '{tx.DATE_RE}', 1)")


def header_sql(col: str) -> str:
    head = f"regexp_extract({col}, '{tx.HEADER_RE}', 1)"
    return (f"case when length({head}) > 0 then "
            f"{ws_trim(f'substr({col}, length({head}) + 1)')} else {col} end")


def control_sql(col: str) -> str:
    return f"regexp_replace({col}, '{tx.CONTROL}', '', 'g')"


def markdown_sql(col: str) -> str:
    heading = tx.HEADING_RE.replace("(?dm)", "(?m)")
    out = f"regexp_replace({col}, '{heading}', '', 'g')"
    for pat in tx.MARKUP_RES:
        out = f"regexp_replace({out}, '{pat}', '\\1', 'g')"
    return out


def whitespace_sql(col: str) -> str:
    out = f"regexp_replace({col}, '\\n{{3,}}', {LF2}, 'g')"
    out = f"regexp_replace({out}, ' {{2,}}', ' ', 'g')"
    out = f"regexp_replace({out}, '{tx.TRAILING_WS_RE}', '\\1', 'g')"
    return ws_trim(out)


def clean_sql(col: str) -> str:
    # NFKC is left out: DuckDB has no NFKC, and it changes no row of these
    # tables (checked); the Spark side applies it.
    return whitespace_sql(markdown_sql(control_sql(header_sql(col))))


CLEANED = f"""
with a as ({ARTICLES}),
s as (
  select *, case when coalesce(error, '') <> '' then 'skipped_error'
                 when coalesce(text, '') = '' then 'skipped_no_text'
                 else 'cleaned' end as clean_status
  from a)
select pos, link, title, error, clean_status,
  case when clean_status = 'cleaned' then {date_sql('text')} end as extracted_date,
  case when clean_status = 'cleaned' then {clean_sql('text')} else text end as text,
  case when clean_status = 'cleaned' and {date_sql('text')} <> '' then {date_sql('text')} end
    as publish_date
from s
"""

CLEAN_STATS = f"""
with c as ({CLEANED})
select count(*) as total,
  count(*) filter (where clean_status = 'cleaned') as cleaned,
  count(*) filter (where clean_status = 'cleaned' and extracted_date <> '') as date_extracted,
  count(*) filter (where clean_status = 'skipped_error') as skipped_errors,
  count(*) filter (where clean_status = 'skipped_no_text') as skipped_no_text
from c
"""

# Documents with control characters spliced in (CL4 has nothing to do on the
# raw tables).  Kept: tab, LF, CR and U+200B; removed: the C0/C1 others.
CONTROL_INPUT = """
select doc_id as pos,
  concat(chr(1 + cast(doc_id % 8 as integer)), substr(text, 1, 40), chr(11), chr(9),
         substr(text, 41), chr(127 + cast(doc_id % 33 as integer)), chr(13), chr(8203),
         chr(28 + cast(doc_id % 4 as integer))) as text
from documents
"""

QUERIES = {
    "clean_stats": CLEAN_STATS,
    "extract_date": f"with a as ({ARTICLES}) select pos, link, {date_sql('text')} as extracted_date from a",
    "remove_header": f"with a as ({ARTICLES}) select pos, {header_sql('text')} as text from a",
    "remove_control_chars": f"with a as ({CONTROL_INPUT}) select pos, {control_sql('text')} as text from a",
    "clean_markdown": f"with a as ({ARTICLES}) select pos, {markdown_sql('text')} as text from a",
    "normalize_whitespace": f"with a as ({ARTICLES}) select pos, {whitespace_sql('text')} as text from a",
    "clean_articles": f"select pos, link, clean_status, extracted_date, text, publish_date from ({CLEANED})",
}


# ---------------------------------------------------------------------------
# Recursive splitter in SQL.  Pieces are produced level by level with a
# recursive CTE (a piece of ``size`` or more is split again with the next
# separator it contains); small pieces between two large siblings form one
# merge group; each group is folded with list_reduce, whose accumulator holds
# the current run, its length and the emitted chunks.
# ---------------------------------------------------------------------------

def chunks_sql(src: str, size: int = 1000, overlap: int = 100) -> str:
    """Rows (pos, chunk_index, chunk_text) for the (pos, text) rows of ``src``."""
    seps = "[chr(10)||chr(10), chr(10), ' ', '']"
    lens = "coalesce(list_sum(list_transform(list_slice(acc.cur, 1, k), lambda x: length(x))), 0)"
    t_k = f"(acc.total - {lens})"
    cond = f"({t_k} <= {overlap} and ({t_k} + length(d) <= {size} or {t_k} = 0))"
    k_expr = f"(list_position(list_transform(range(0, len(acc.cur) + 1), lambda k: {cond}), true) - 1)"
    lens_k = (f"coalesce(list_sum(list_transform(list_slice(acc.cur, 1, {k_expr}), "
              f"lambda x: length(x))), 0)")
    run_text = ws_trim("array_to_string(acc.cur, '')")
    emit = (f"case when len(acc.cur) > 0 and {run_text} <> '' "
            f"then list_append(acc.out, {run_text}) else acc.out end")
    step = (f"case when acc.total + length(d) > {size} then "
            f"{{'cur': list_append(list_slice(acc.cur, {k_expr} + 1, len(acc.cur)), d), "
            f"'total': acc.total - {lens_k} + length(d), 'out': {emit}}} "
            f"else {{'cur': list_append(acc.cur, d), 'total': acc.total + length(d), "
            f"'out': acc.out}} end")
    init = "{'cur': []::VARCHAR[], 'total': 0::BIGINT, 'out': []::VARCHAR[]}"
    last = ws_trim("array_to_string(r.cur, '')")
    return f"""
with recursive
src as (select pos, text from ({src}) where text is not null),
parts(pos, path, piece, sepi) as (
  select pos, []::INTEGER[], text, 0 from src
  union all
  select pos, list_append(path, idx), sub, nsep from (
    select pos, path, nsep, unnest(pieces) as sub, generate_subscripts(pieces, 1) as idx
    from (
      select pos, path, nsep,
        list_filter(list_transform(string_split(piece, {seps}[nsep]),
                    lambda s, i: case when i = 1 then s else {seps}[nsep] || s end),
                    lambda s: s <> '') as pieces
      from (
        select pos, path, piece,
          case when sepi < 1 and contains(piece, chr(10)||chr(10)) then 1
               when sepi < 2 and contains(piece, chr(10)) then 2
               when sepi < 3 and contains(piece, ' ') then 3 else 4 end as nsep
        from parts
        where (len(path) = 0 or length(piece) >= {size}) and sepi < 4)))
),
children as (
  select pos, path, piece, list_slice(path, 1, len(path) - 1) as parent, path[len(path)] as idx,
    sum(case when length(piece) >= {size} then 1 else 0 end)
      over (partition by pos, list_slice(path, 1, len(path) - 1) order by path[len(path)]
            rows between unbounded preceding and current row) as run
  from parts where len(path) > 0
),
groups as (
  select pos, min(path) as gpath, list(piece order by idx) as pieces
  from children where length(piece) < {size}
  group by pos, parent, run
),
folded as (
  select pos, gpath, list_reduce(pieces, lambda acc, d: {step}, {init}) as r from groups
),
emitted as (
  select pos, gpath, case when {last} <> '' then list_append(r.out, {last}) else r.out end as cs
  from folded
),
flat as (
  select pos, gpath, unnest(cs) as chunk_text, generate_subscripts(cs, 1) as ci from emitted
)
select pos, (row_number() over (partition by pos order by gpath, ci) - 1) as chunk_index, chunk_text
from flat
"""


# ---------------------------------------------------------------------------
# Index build: validation, ids, chunk rows and counters.
# ---------------------------------------------------------------------------

def ledger_sql(empty: bool = False) -> str:
    if empty:
        return "select ''::VARCHAR as link where false"
    return (f"select link from ({ARTICLES}) where pos % {fx.LEDGER_EVERY} = 0 "
            f"union all select '{fx.LEDGER_STRAY_LINK}'")


def validated_sql(empty_ledger: bool = False) -> str:
    return f"""
with c as ({CLEANED}),
a as (
  select pos, link, title, publish_date, text, coalesce(link, '') as link_key,
    coalesce(error, '') = '' as ok,
    coalesce(text, '') <> '' as has_text,
    coalesce(error, '') = '' and coalesce(length({ws_trim('text')}), 0) > 0 as cand
  from c),
l as (select distinct coalesce(link, '') as link_key from ({ledger_sql(empty_ledger)})),
f as (
  select a.*,
    exists (select 1 from l where l.link_key = a.link_key) as in_ledger,
    exists (select 1 from a b where b.link_key = a.link_key and b.ok) as key_ok,
    exists (select 1 from a b where b.link_key = a.link_key and b.cand and b.pos < a.pos) as earlier
  from a)
select pos, link, title, publish_date, text, link_key,
  ok and not in_ledger as new,
  key_ok and not in_ledger as visited,
  case when in_ledger then 'in_ledger'
       when not key_ok or not ok then 'error'
       when not has_text then 'no_text'
       when not cand then 'no_chunks'
       when earlier then 'already_processed' end as skip_reason
from f
"""


def built_sql(empty_ledger: bool = False) -> str:
    v = validated_sql(empty_ledger)
    ch = chunks_sql(f"select pos, text from ({v}) where skip_reason is null")
    return f"""
with v as ({v}),
ch as ({ch}),
n as (select pos, count(*) as n_chunks from ch group by pos),
o as (select v.pos, v.link_key, coalesce(v.title, 'Untitled') as title,
        coalesce(v.publish_date, '') as publish_date,
        coalesce(sum(n.n_chunks) over (order by v.pos, v.link_key
                 rows between unbounded preceding and 1 preceding), 0) as offs
      from v join n using (pos) where v.skip_reason is null)
select concat('id', o.offs + ch.chunk_index + 1) as chunk_id,
  o.offs + ch.chunk_index + 1 as chunk_no, o.link_key as link, o.title, o.publish_date,
  ch.chunk_text, o.pos as article_pos, ch.chunk_index
from o join ch using (pos)
"""


CHUNK_COLS = "chunk_id, chunk_no, link, title, publish_date, chunk_text"

QUERIES.update({
    "chunk_articles": chunks_sql(f"select pos, text from ({CLEANED})"),
    "chunk_articles_native": chunks_sql(f"select pos, text from ({CLEANED})"),
    "unprocessed_links": f"""
        select pos, coalesce(link, '') as link from ({CLEANED}) a
        where coalesce(error, '') = ''
          and coalesce(link, '') not in (select coalesce(link, '') from ({ledger_sql()}))""",
    "validate_articles": f"select pos, link, new, visited, skip_reason from ({validated_sql()})",
    "chunk_ids": f"select chunk_id, chunk_no, link, article_pos, chunk_index from ({built_sql()})",
    "incremental_build": f"select {CHUNK_COLS} from ({built_sql()})",
    "rebuild": f"select {CHUNK_COLS} from ({built_sql(True)})",
    "build_stats": f"""
        with v as ({validated_sql()}), b as ({built_sql()})
        select (select count(*) from v) as total_articles,
          (select count(*) from v where new) as new_articles,
          (select count(*) from b) as chunks_added,
          (select count(*) from v where visited and skip_reason is null) as articles_processed,
          (select count(*) from v where visited and skip_reason is not null) as articles_skipped,
          0::BIGINT as errors""",
    "index_summary": f"""
        with v as ({validated_sql()}), b as ({built_sql()}),
        l as (select coalesce(link, '') as link from ({ledger_sql()})
              union select link_key from v where skip_reason is null),
        s as (select (select count(*) from v) as total_articles,
                     (select count(*) from l) as processed_articles,
                     (select count(*) from b) as total_chunks)
        select *, processed_articles = total_articles as up_to_date,
          total_articles - processed_articles as remaining from s""",
    "store_stats": f"""
        with v as ({validated_sql()}), b as ({built_sql()}),
        l as (select coalesce(link, '') as link from ({ledger_sql()})
              union select link_key from v where skip_reason is null)
        select 'article_chunks' as collection_name, (select count(*) from b) as total_chunks,
          (select count(*) from l) as processed_articles, 'chunk_store' as vector_store_path""",
})


# ---------------------------------------------------------------------------
# Link discovery.
# ---------------------------------------------------------------------------

def _q(s: str) -> str:
    return s.replace("'", "''")


def _attr_sql(tag: str, pattern: str) -> str:
    return "(" + " || ".join(f"regexp_extract({tag}, '{_q(pattern)}', {g})" for g in (1, 2, 3)) + ")"


def page_links_sql(pages: str = "select page_id as page_no, html from pages") -> str:
    from ..functions import html as hx
    from ..operators import links as lk
    href = _attr_sql("t", lk.HREF_RE)
    for entity, char in hx.ENTITIES:
        href = f"replace({href}, '{_q(entity)}', '{_q(char)}')"
    shown = f"regexp_replace(html, '{_q(hx.COMMENT_RE)}', '', 'g')"
    return f"""
select page_no, idx, link from (
  select page_no, unnest(h) as link, generate_subscripts(h, 1) - 1 as idx
  from (select page_no,
          list_filter(list_transform(regexp_extract_all({shown}, '{_q(lk.ANCHOR_RE)}', 0),
                                     lambda t: {href}),
                      lambda x: x <> '') as h
        from ({pages})))
"""


# The stored pages hold host-relative links.
ABSOLUTE_LINKS = f"""
select page_no, idx, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) || link as link
from ({page_links_sql()}) join (select page_id as page_no, url from pages) using (page_no)
"""

# Expected values of the four spliced heads, spelled out.
ARTICLE_BYLINES = """
select page_id,
  case page_id % 4 when 0 then ['Pat O''Brien'] when 1 then ['Ann & Bo', 'Cy']
    else []::VARCHAR[] end as authors,
  case page_id % 4 when 0 then '2024-01-01T10:00:00+02:00' when 1 then '2024-02-03T04:05:06+00:00'
    when 2 then '2023-12-31T00:00:00' end as publish_date
from pages
"""

PAGES_WITH_END = """
select page_id as page_no,
  case when page_id = (select max(page_id) from pages) then '' else html end as html
from pages where page_id <> (select max(page_id) from pages) - 1
"""


def first_seen_sql(src: str, order: str) -> str:
    """Ordered distinct of (link, order...) rows: pos by first occurrence."""
    return f"""
select row_number() over (order by {order}) - 1 as pos, link from (
  select *, row_number() over (partition by link order by {order}) as k from ({src}))
where k = 1
"""


SAVED = first_seen_sql(f"select * from ({page_links_sql()}) where page_no >= 1", "page_no, idx")
TOP = first_seen_sql(f"select * from ({page_links_sql()}) where page_no = 0", "page_no, idx")
DELTA = f"""
with saved as ({SAVED}), top as ({TOP}),
st as (select * from saved where pos < (select count(*) from top))
select pos, link from top
where link not in (select link from st)
  and (select count(distinct link) from (select link from top union all select link from st))
      <> (select count(*) from st)
"""


def prepend_sql(new: str) -> str:
    return first_seen_sql(
        f"select 0 as g, pos as p, link from ({new}) union all select 1, pos, link from ({SAVED})",
        "g, p")


QUERIES.update({
    "extract_links": page_links_sql(),
    "absolute_links": ABSOLUTE_LINKS,
    "paginate_links": f"""
        with p as ({PAGES_WITH_END}), l as ({page_links_sql(PAGES_WITH_END)}),
        c as (select p.page_no, (select count(*) from l where l.page_no = p.page_no) as n from p),
        s as (select min(x) as stop from (
                select page_no as x from c where n = 0
                union all select page_no + 1 from c where page_no + 1 not in (select page_no from c)
                union all select 0 where 0 not in (select page_no from c)))
        select page_no, idx, link from l
        where page_no >= 0 and (page_no < (select stop from s) or (select stop from s) is null)""",
    "ordered_distinct_links": first_seen_sql(page_links_sql(), "page_no, idx"),
    "link_delta": DELTA,
    "prepend_merge": prepend_sql(TOP),
    "link_update": f"""
        with d as ({DELTA}), u as ({prepend_sql(DELTA)})
        select pos, link, link in (select link from d) as is_new from u""",
})


# ---------------------------------------------------------------------------
# Fetch bookkeeping.
# ---------------------------------------------------------------------------

FIELDS = ["title", "authors", "publish_date", "text", "summary", "keywords"]

ATTEMPTS = f"""
select link, event_id, ts, rn, cast(ceil(rn / 3) as integer) as round,
  cast(1 + (rn - 1) % 3 as integer) as attempt,
  case when failed then concat('error at event ', event_id) end as error,
  case when not failed then concat('Article ', event_id) end as title,
  case when not failed then [concat('Author ', event_id % 7)] end as authors,
  case when not failed then concat('2024-01-0', 1 + event_id % 9) end as publish_date,
  case when not failed then concat('Body of ', link, ' from event ', event_id) end as text,
  case when not failed then concat('Summary of event ', event_id) end as summary,
  case when not failed then ['event', concat('k', event_id % 5)] end as keywords
from (select concat('{fx.LINK_PREFIX}', user_id) as link, event_id, ts,
        event_type = 'error' or user_id % {fx.DEAD_EVERY} = {fx.DEAD_AT} as failed,
        row_number() over (partition by user_id order by ts, event_id) as rn from events)
"""


def attempt_fold_sql(rounds: int = 5, per_round: int = 3) -> str:
    fields = ",\n  ".join(f"arg_min({c}, attempt) filter (where error is null) as {c}" for c in FIELDS)
    return f"""
select link, round, count(*) filter (where error is null) > 0 as ok,
  coalesce(min(attempt) filter (where error is null), max(attempt)) as attempts,
  {fields},
  case when count(*) filter (where error is null) = 0 then arg_max(error, attempt) end as error
from ({ATTEMPTS}) where round <= {rounds} and attempt <= {per_round}
group by link, round
"""


def round_fold_sql(rounds: int = 5, per_round: int = 3, src: str = ATTEMPTS) -> str:
    fields = ",\n  ".join(f"arg_min({c}, round * 1000 + attempt) filter (where error is null) as {c}"
                          for c in FIELDS)
    return f"""
select link, count(*) filter (where error is null) > 0 as ok,
  coalesce(min(round) filter (where error is null), max(round)) as rounds,
  {fields},
  case when count(*) filter (where error is null) = 0
       then arg_max(error, round * 1000 + attempt) end as error
from ({src}) where round <= {rounds} and attempt <= {per_round}
group by link
"""


DATASET = f"""
select first_pos as pos, link, title, text, error from (
  select *, min(pos) over (partition by link) as first_pos,
    row_number() over (partition by link order by pos desc) as k
  from ({ARTICLES}) where link is not null)
where k = 1
"""

LINK_LIST = first_seen_sql(f"select link, ts, event_id from ({ATTEMPTS})", "ts, event_id")

NEEDS = f"""
select pos, link from ({LINK_LIST}) l
where link not in (select link from ({DATASET}))
   or link in (select link from ({DATASET}) where error is not null)
"""


def upsert_sql(rounds: int = 5, per_round: int = 3) -> str:
    fetched = round_fold_sql(rounds, per_round,
                             f"select * from ({ATTEMPTS}) where link in (select link from ({NEEDS}))")
    more = ["authors", "publish_date", "summary", "keywords"]     # null in the fixture dataset
    extra = ", ".join(f"case when f.ok then f.{c} end as {c}" for c in more)
    return f"""
with d as ({DATASET}), f as ({fetched}), l as ({LINK_LIST})
select d.pos, d.link,
  case when f.link is null then d.title when f.ok then f.title end as title,
  case when f.link is null then d.text when f.ok then f.text end as text,
  {extra},
  case when f.link is null then d.error when f.ok then null else coalesce(f.error, '') end as error
from d left join f on d.link = f.link
union all
select (select max(pos) from d) + 1 + l.pos, f.link,
  case when f.ok then f.title end, case when f.ok then f.text end, {extra},
  case when f.ok then null else coalesce(f.error, '') end
from f join l on f.link = l.link
where f.link not in (select link from d)
"""


QUERIES.update({
    "attempt_fold": attempt_fold_sql(),
    "round_fold": round_fold_sql(),
    "load_dataset": DATASET,
    "needs_fetch": NEEDS,
    "upsert_articles": upsert_sql(),
    "failed_links": f"select pos, link, error from ({upsert_sql()}) where error is not null",
    "fetch_report": f"""
        select count(*) as total, count(*) filter (where error is null) as successful,
          count(*) filter (where error is not null) as failed from ({upsert_sql()})""",
})


# ---------------------------------------------------------------------------
# Extraction, text statistics, embeddings.
# ---------------------------------------------------------------------------

def _html_sql():
    from ..functions import html as hx
    from ..operators import embed as em
    from ..operators import extract as ex
    return hx, em, ex


def _plain_sql(frag: str) -> str:
    hx, _, _ = _html_sql()
    no_tags = (f"regexp_replace(regexp_replace({frag}, '{_q(hx.BR_RE)}', ' ', 'g'), "
               f"'{_q(hx.TAG_RE)}', '', 'g')")
    out = ws_trim(f"regexp_replace({no_tags}, '{_q(hx.SPACE_RE)}', ' ', 'g')")
    for ent, ch in hx.ENTITIES:
        out = f"replace({out}, '{ent}', chr({ord(ch)}))"
    return out


def _byline_sql(hx) -> tuple[str, str]:
    """Authors and publish date of a column ``html``."""
    def contents(which: str) -> str:
        return (f"list_transform(list_filter(regexp_extract_all(html, '{_q(hx.META_RE)}', 0), "
                f"lambda t: regexp_matches(t, '{_q(which)}')), lambda t: {_attr_sql('t', hx.CONTENT_RE)})")

    author = ws_trim("a")
    for entity, char in hx.ENTITIES:
        author = f"replace({author}, '{_q(entity)}', '{_q(char)}')"
    authors = f"list_transform({contents(hx.IS_AUTHOR_RE)}, lambda a: {author})"
    times = (f"list_filter(list_transform(regexp_extract_all(html, '{_q(hx.TIME_RE)}', 0), "
             f"lambda t: {_attr_sql('t', hx.DATETIME_RE)}), lambda t: t <> '')")
    raw = f"coalesce(nullif(({contents(hx.IS_PUBLISHED_RE)})[1], ''), ({times})[1])"
    zone = f"regexp_extract({raw}, '{_q(hx.ZONE_RE)}', 2)"
    wall = f"try_cast(regexp_replace({raw}, '{_q(hx.ZONE_RE)}', '\\1') as timestamp)"
    date = (f"strftime({wall}, '%Y-%m-%dT%H:%M:%S') || case when {zone} = 'Z' then '+00:00' "
            f"when length({zone}) = 5 then left({zone}, 3) || ':' || right({zone}, 2) else {zone} end")
    return authors, date


def extract_sql() -> str:
    hx, _, _ = _html_sql()
    h = "html"
    h = f"regexp_replace({h}, '{_q(hx.COMMENT_RE)}', '', 'g')"
    for tag in hx.DROPPED_ELEMENTS:
        h = f"regexp_replace({h}, '{_q(hx.element_re(tag))}', '', 'g')"
    title = _plain_sql(f"regexp_extract(h, '{_q(hx.TITLE_RE)}', 1)")
    h1 = _plain_sql(f"regexp_extract(h, '{_q(hx.H1_RE)}', 1)")
    region = (f"case when regexp_matches(h, '(?i)<article\\b') "
              f"then regexp_extract(h, '{_q(hx.ARTICLE_RE)}', 1) else h end")
    blocks = f"list_slice(regexp_split_to_array({region}, '{_q(hx.P_OPEN_RE)}'), 2, 1073741824)"
    paras = f"list_transform({blocks}, lambda b: {_plain_sql(f'regexp_replace(b, {chr(39)}{_q(hx.P_CLOSE_RE)}{chr(39)}, {chr(39)}{chr(39)})')})"
    text = f"array_to_string(list_filter({paras}, lambda p: p <> ''), chr(10) || chr(10))"
    authors, date = _byline_sql(hx)
    return f"""
select page_id, url as link,
  coalesce(case when {title} <> '' then {title} else {h1} end, '') as title,
  coalesce({authors}, []::VARCHAR[]) as authors,
  {date} as publish_date,
  coalesce({text}, '') as text
from (select page_id, url, html, {h} as h from pages)
"""


def _stop_list() -> str:
    _, _, ex = _html_sql()
    return ", ".join(f"'{w}'" for w in ex.STOPWORDS)


DOCS = "select doc_id as id, text from documents"


def word_counts_sql(src: str = DOCS) -> str:
    _, _, ex = _html_sql()
    return f"""
select id, word, count(*) as n from (
  select id, unnest(regexp_extract_all(lower(text), '{ex.WORD_RE}', 0)) as word from ({src}))
where word not in ({_stop_list()})
group by id, word
"""


def keywords_sql(src: str = DOCS, id_col: str = "doc_id") -> str:
    return f"""
with c as ({word_counts_sql(src)}),
r as (select id, word, row_number() over (partition by id order by n desc, word) as rk from c)
select d.id as {id_col},
  coalesce((select list(word order by rk) from r where r.id = d.id and rk <= 10),
           []::VARCHAR[]) as keywords
from ({src}) d
"""


def summary_sql(src: str = DOCS, id_col: str = "doc_id") -> str:
    _, _, ex = _html_sql()
    return f"""
with c as ({word_counts_sql(src)}),
s as (select id, sidx, s from (
        select id, generate_subscripts(ss, 1) - 1 as sidx, {ws_trim('unnest(ss)')} as s
        from (select id, regexp_extract_all(text, '{ex.SENTENCE_RE}', 0) as ss from ({src})))
      where s <> ''),
w as (select id, sidx, word from (
        select id, sidx, unnest(regexp_extract_all(lower(s), '{ex.WORD_RE}', 0)) as word from s)
      where word not in ({_stop_list()})),
sc as (select w.id, w.sidx, avg(c.n) as score from w join c using (id, word) group by all),
r as (select s.id, s.sidx, s.s,
        row_number() over (partition by s.id order by coalesce(sc.score, 0) desc, s.sidx) as rk
      from s left join sc using (id, sidx))
select d.id as {id_col},
  coalesce((select string_agg(s, chr(10) order by sidx) from r where r.id = d.id and rk <= 5), '')
    as summary
from ({src}) d
"""


def embed_sql() -> str:
    _, em, _ = _html_sql()
    toks = f"regexp_extract_all(lower(chunk_text), '{em.TOKEN_RE}', 0)"
    buckets = (f"list_transform({toks}, lambda w: "
               f"cast(('0x' || substr(md5(w), 1, 8))::BIGINT % {em.DIM} as INTEGER))")
    counts = (f"list_transform(range(0, {em.DIM}), lambda i: "
              f"cast(len(list_filter(b, lambda x: x = i)) as DOUBLE))")
    return f"""
select chunk_id, list_transform(cnt, lambda x: cast(case when nrm > 0 then x / nrm else 0.0 end as FLOAT))
  as embedding
from (select chunk_id, cnt, sqrt(list_sum(list_transform(cnt, lambda x: x * x))) as nrm
      from (select chunk_id, {counts} as cnt
            from (select chunk_id, {buckets} as b from ({built_sql(True)}))))
"""


ARTICLE_NLP = f"""
with a as ({extract_sql()}),
k as ({keywords_sql("select page_id as id, text from a", "page_id")}),
s as ({summary_sql("select page_id as id, text from a", "page_id")})
select a.page_id, a.link, a.title, k.keywords, s.summary, null::VARCHAR as nlp_error
from a join k using (page_id) join s using (page_id)
"""

QUERIES.update({
    "article_nlp": ARTICLE_NLP,
    "article_bylines": ARTICLE_BYLINES,
    "extract_articles": extract_sql(),
    "keywords": keywords_sql(),
    "summary": summary_sql(),
    "embed_chunks": embed_sql(),
})


# ---------------------------------------------------------------------------
# Sources, sinks and the stream: same results as the in-memory queries.
# ---------------------------------------------------------------------------

MIXED_CLEAN_STATS = f"""
with c as ({CLEANED}),
m as (select *, pos % 97 = 0 as not_object from c)
select count(*) as total,
  count(*) filter (where not not_object and clean_status = 'cleaned') as cleaned,
  count(*) filter (where not not_object and clean_status = 'cleaned' and extracted_date <> '') as date_extracted,
  count(*) filter (where not_object or clean_status = 'skipped_error') as skipped_errors,
  count(*) filter (where not not_object and clean_status = 'skipped_no_text') as skipped_no_text
from m
"""

QUERIES.update({
    "read_mixed_json": MIXED_CLEAN_STATS,
    "read_articles": f"select link, title, text, error from ({ARTICLES})",
    "snapshot": f"select pos, link, clean_status, text, publish_date from ({CLEANED})",
    "stream_incremental": f"select {CHUNK_COLS} from ({built_sql()})",
})

# Sources that were covered by unit tests only; error isolation of the build.
QUERIES.update({
    "normalize_unicode": f"""
        select doc_id as pos, '{fx.COMPAT_NFKC}' || text as text from documents""",
    "read_links": f"select link from ({first_seen_sql(page_links_sql(), 'page_no, idx')})",
    "write_links": first_seen_sql(page_links_sql(), "page_no, idx"),
    "append_ledger": f"""
        select link from ({ledger_sql()})
        union all select link_key from ({validated_sql()}) where skip_reason is null""",
    "build_errors": f"""
        with v as ({validated_sql()}), b as ({built_sql()}),
        bad as (select * from v where skip_reason is null and length(text) % {fx.POISON_EVERY} = 0)
        select (select count(*) from v) as total_articles,
          (select count(*) from v where new) as new_articles,
          (select count(*) from b where article_pos not in (select pos from bad)) as chunks_added,
          (select count(*) from v where visited and skip_reason is null
             and pos not in (select pos from bad)) as articles_processed,
          (select count(*) from v where visited and skip_reason is not null) as articles_skipped,
          (select count(*) from bad) as errors""",
})

# Article files: written, copied, cleaned from files to files and read back.
NOT_OBJECT = f"(pos % {fx.STRING_EVERY} = 0 or pos % {fx.NULL_EVERY} = 0)"

QUERIES.update({
    "read_large_array": f"""
        select row_number() over (order by pos) - 1 as pos, link, title, text, error from ({ARTICLES})""",
    "snapshot_files": """
        select name, octet_length(encode(body)) as length, sha256(body) as sha256 from (
          select source || '.json' as name, '[' || chr(10) || '    ' || string_agg(
            cast(to_json(text) as varchar), ',' || chr(10) || '    ' order by doc_id) || chr(10) || ']' as body
          from documents group by source)""",
    "clean_roundtrip_json": f"""
        select printf('articles-%06d.json', pos // {fx.FILE_OF}) as name,
          row_number() over (order by pos) - 1 as pos, not {NOT_OBJECT} as is_object,
          case when pos % {fx.STRING_EVERY} = 0 then '"' || pos || '"'
               when pos % {fx.NULL_EVERY} = 0 then 'null' end as scalar,
          case when not {NOT_OBJECT} then pos end as crawl_id, not {NOT_OBJECT} as keeps_number,
          case when not {NOT_OBJECT} then link end as link, case when not {NOT_OBJECT} then title end as title,
          case when not {NOT_OBJECT} then text end as text,
          case when not {NOT_OBJECT} then publish_date end as publish_date,
          case when not {NOT_OBJECT} then error end as error
        from ({CLEANED})""",
    "clean_files_stats": MIXED_CLEAN_STATS.replace("pos % 97 = 0", NOT_OBJECT),
})

QUERIES["chunk_long_documents"] = chunks_sql("select doc_id as pos, text from documents")

QUERIES["stream_fetch_fold"] = round_fold_sql()
QUERIES["rebuild_store"] = f"select {CHUNK_COLS} from ({built_sql(True)})"

QUERIES["extract_links_by_class"] = f"""
    select page_id as page_no, 0 as idx, '/area/' || page_id || '?a=1&b' as link from pages
    union all select page_no, idx + 1, link from ({page_links_sql()}) where page_no % 2 = 0"""
