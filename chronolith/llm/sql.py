"""DuckDB SQL of the queries that SQL can express."""

# the ten queries' tables are registered as views; each statement reads whole tables

def _secret_spans(kind: str, pattern: str, group: int, least: int, rank: int) -> str:
    return f"""
      select doc_id, source, lang, {rank} as rank, '{kind}' as kind,
             unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
               'end': list_sum(list_transform(pieces[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x))),
               'hit': hits[i], 'value': vals[i]}})) as s
      from (select doc_id, source, lang, regexp_extract_all(t, {pattern}) as hits, regexp_extract_all(t, {pattern}, {group}) as vals, string_split_regex(t, {pattern}) as pieces
            from (select doc_id, source, lang, coalesce(text, '') as t from documents))"""


def _secrets() -> str:
    from chronolith.llm.secrets import EXAMPLE_OWNERS, EXAMPLE_REPOS, LEAST_VARIETY, PLACEHOLDERS

    word = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    assign = f"""'{word}["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
    placeholder = " or ".join(f"contains(lower(value), '{w}')" for w in PLACEHOLDERS)
    return f"""
    with raw as (
      {_secret_spans("assign", assign, 2, 12, 0)} union all {_secret_spans("access", "'AKIA[A-Z0-9]+'", 0, 18, 1)} union all
      {_secret_spans("hex", "'[0-9a-f]+'", 0, 16, 2)} union all {_secret_spans("mixed", "'[A-Za-z0-9+/_=-]+'", 0, 20, 3)}),
    cand as (
      select doc_id, source, lang, rank, kind, cast(s['end'] - length(s['hit']) as bigint) as b, cast(s['end'] as bigint) as e, s['value'] as value from raw
      where case kind when 'assign' then length(s['value']) >= 12 when 'access' then length(s['value']) >= 18 when 'hex' then length(s['value']) >= 16
            else length(s['value']) >= 20 and regexp_matches(s['value'], '[a-z]') and regexp_matches(s['value'], '[A-Z]') and regexp_matches(s['value'], '[0-9]') end),
    owned as (
      select value, count(distinct coalesce(source, '')) as n_owners, count(distinct coalesce(source, '') || chr(1) || coalesce(lang, '')) as n_repos from cand group by value),
    judged as (
      select c.*, n_owners >= {EXAMPLE_OWNERS} or n_repos >= {EXAMPLE_REPOS} as example,
             n_owners < {EXAMPLE_OWNERS} and n_repos < {EXAMPLE_REPOS} and not ({placeholder}) and len(list_distinct(string_split(value, ''))) >= {LEAST_VARIETY} as live
      from cand c join owned using (value)),
    spans as (
      select doc_id, rank, kind, b, e from judged where kind <> 'mixed' union all
      select distinct doc_id, 3, 'live', e - length(value), e from judged where live),
    per as (
      select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
             string_agg(kind || ':' || b || ':' || e, ',' order by b, rank, e) filter (where kind <> 'live') as base,
             string_agg(kind || ':' || b || ':' || e, ',' order by b, rank, e) as spans, count(*) filter (where kind = 'live') as n_live
      from spans group by doc_id),
    ex as (select doc_id, count(*) filter (where example) as n_example from judged group by doc_id)
    select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
           coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example
    from documents d left join per on per.doc_id = d.doc_id left join ex on ex.doc_id = d.doc_id"""


SECRETS = _secrets()

CHAT = r"""
    with given as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all
      select -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
    turns as (
      select *, row_number() over w as k, count(*) over (partition by conv_id) as n,
             length('<|im_start|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 1 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|im_end|>') + 1 as chars
      from given window w as (partition by conv_id order by turn nulls first, role, text)),
    upto as (select *, sum(chars) over (partition by conv_id order by k) as prefix from turns)
    select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
           coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), '')) as loss_sha256,
           (sum(prefix) filter (where role = 'assistant' or k = n))::bigint as formatted_chars,
           count(*) filter (where role = 'assistant' or k = n) as n_examples
    from upto group by conv_id"""


def _mixing() -> str:
    from chronolith.llm.mixing import LEAST_QUALITY, MOST_EPOCHS, SYMBOLS

    return f"""
    with sized as (
      select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
             -ln((('0x' || md5('7:' || doc_id::varchar)[1:13])::bigint + 0.5) / 4503599627370496.0)
               / greatest({LEAST_QUALITY}, 1.0 - 2.0 * ((length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{SYMBOLS}', ''))) / greatest(length(coalesce(text, '')), 1))) as key
      from documents),
    src as (
      select source, sum(size)::bigint as source_size, {MOST_EPOCHS} * sum(size)::bigint as cap,
             ([5.0, 2.0, 1.0]::double[])[((row_number() over (order by source nulls last)) - 1) % 3 + 1] as weight
      from sized group by source),
    lev as (
      select *, (sum(source_size) over () - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0))::double
                / sum(weight) over (w rows between current row and unbounded following) as level
      from src window w as (order by cap / weight, source nulls last)),
    goal as (
      select source, source_size,
             case when cap <= level * weight then cap::double else max(case when cap <= level * weight then null else level end) over () * weight end as target
      from lev),
    placed as (
      select s.doc_id, s.size, g.source_size, g.target, case when g.source_size > 0 then floor(g.target / g.source_size)::bigint else 0 end as epochs,
             sum(s.size) over (partition by s.source order by s.key, s.doc_id rows unbounded preceding) as after_
      from sized s join goal g on s.source is not distinct from g.source)
    select doc_id, size, source_size::bigint as source_size, target,
           (size * (epochs + case when target - epochs * source_size > 0 and 2 * (target - epochs * source_size) >= 2 * after_ - size then 1 else 0 end))::bigint as taken
    from placed"""


MIXING = _mixing()

DEDUP = """
    select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window w as (partition by coalesce(text, ''))"""

WARC = """
    with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
    r as (select *, min(page_id) over (partition by html) as first_id from p)
    select page_id, octet_length(encode(html))::bigint as payload_bytes,
           list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([32768, 1024, 32, 1], lambda d:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, i * 5 + 1, 5))::bigint // d) % 32) + 1)::bigint, 1)), 'string_agg', '')), 'string_agg', '') as payload_digest,
           case when page_id = first_id then 'response' else 'revisit' end as record_type,
           case when page_id = first_id then null else first_id end as refers_to
    from r"""
