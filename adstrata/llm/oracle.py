"""DuckDB twins of the operators' queries, where SQL can say what they return.

Class scores, decoding worklists and learned scores are not expressible; chunk removal with its byte
comparison is tested against a direct reading of its definition instead.
"""

from __future__ import annotations

from .licenses import DRIFT, K, MAX_STRETCH, MIN_SHARE, PHRASES, TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TOKENS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP1 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= 20
"""

OP4 = f"""
with recursive w as (
  select doc_id, {_TOKENS} as w from documents
), s as (
  select distinct doc_id, array_to_string(w[p : p + least(5, len(w)) - 1], ' ') as shingle
  from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as p from w where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by 1
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (shingle) where a.doc_id <> b.doc_id group by 1, 2
), links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)
), reached(a, b) as (
  select doc_id, doc_id from documents union select r.a, l.b from reached r join links l on l.a = r.b
), root as (
  select a, min(b) as component_id from reached group by 1
), degree as (
  select a, count(*) as n_links from links group by 1
)
select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, coalesce(n_links, 0) as n_links
from documents d join root on root.a = d.doc_id left join n using (doc_id) left join degree on degree.a = d.doc_id
"""

OP5 = """
with p as (
  select page_id, coalesce(html, '') as body, sha256(coalesce(html, '')) as digest from pages
), q as (
  select page_id, strlen(body) as payload_bytes, digest, min(page_id) over (partition by digest) as first_id from p
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, digest as payload_digest,
  case when payload_bytes >= 100 and first_id < page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and first_id < page_id then first_id end as refers_to
from q
"""

OP6 = f"""
with d as (
  select row_number() over () as r, doc_id, {_WORDS} as w from documents
), i as (
  select coalesce(cast(item_id as varchar), '') as item, {_WORDS} as w from benchmark
), windows as (
  select distinct item, size, array_to_string(w[p : p + size - 1], ' ') as gram
  from (select item, w, least(10, len(w)) as size, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p from i where len(w) > 0)
), sizes as (
  select distinct size from windows
), grams as (
  select r, p, size, array_to_string(w[p : p + size - 1], ' ') as gram
  from (select r, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) as p from d, sizes)
), hits as (
  select r, p, size, item from grams join windows using (size, gram)
), hit_words as (
  select r, count(distinct pos) as n_hit from (select r, unnest(range(p, p + size)) as pos from hits) group by 1
), hit_items as (
  select r, count(distinct item) as n_items, sha256(string_agg(distinct item, ',' order by item)) as items_sha256 from hits group by 1
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (r) left join hit_items using (r)
"""


def _shared(level: str, parents: list[str], weights: dict[str, int]) -> str:
    """Budgets of one level from those of the level above."""
    cases = "".join(f" when '{k}' then {v}" for k, v in sorted(weights.items()))
    weight = f"case {level} {cases} else 1 end" if cases else "1"
    above = f"shared_{len(parents)}"
    keys = ", ".join(parents)
    part = f"partition by {keys}" if parents else ""
    order = f"{part} order by cap / weight, {level}"
    on = f"using ({keys})" if parents else "on true"
    named = f"{keys}, {level}" if parents else level
    return f"""
nodes_{level} as (
  select {named}, sum(cap) as cap, {weight} as weight from leaves group by all
), fits_{level} as (
  select n.*, budget,
    cap::hugeint * sum(weight) over ({order} rows between current row and unbounded following)
      <= weight::hugeint * (budget - coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0)) as fits
  from nodes_{level} n join {above} {on}
), full_{level} as (
  select *, bool_and(fits) over ({order} rows between unbounded preceding and current row) as is_full from fits_{level}
), shared_{len(parents) + 1} as (
  select {named}, cast(case when is_full then cap else
    (weight::hugeint * (budget - coalesce(sum(cap) filter (is_full) over ({part}), 0))::hugeint)
      // greatest(coalesce(sum(weight) filter (not is_full) over ({part}), 0), 1)::hugeint end as bigint) as budget
  from full_{level}
)"""


def _op8() -> str:
    from .mixing import MAX_EPOCHS, SEED
    from .queries import MIX_LEVELS, MIX_SHARE, MIX_WEIGHTS

    levels = ", ".join(MIX_LEVELS)
    shared, parents = [], []
    for level in MIX_LEVELS:
        shared.append(_shared(level, parents, MIX_WEIGHTS.get(level, {})))
        parents.append(level)
    return rf"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    case when length(coalesce(text, '')) < 1000 then 'brief' when length(text) < 8000 then 'article' else 'long' end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens,
    md5(coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))) as k
  from documents
), units as (
  select k, {levels}, n_tokens, n_tokens * count(*) as n_all, substr(k, 1, 3) as bucket from d group by k, {levels}, n_tokens
), buckets as (
  select {levels}, bucket, cast(sum(n_all) as bigint) as n from units group by all
), leaves as (
  select {levels}, cast(sum(n) as bigint) as tokens, cast(sum(n) as bigint) * {MAX_EPOCHS} as cap from buckets group by all
), shared_0 as (
  select least(cast(sum(tokens) as bigint) * {round(1000 * MIX_SHARE)} // 1000, cast(sum(cap) as bigint)) as budget from leaves
), {", ".join(shared)}, plan as (
  select {levels}, case when tokens = 0 then 0 else budget // greatest(tokens, 1) end as complete,
    case when tokens = 0 then 0 else budget % greatest(tokens, 1) end as rest
  from leaves join shared_{len(MIX_LEVELS)} using ({levels})
), placed as (
  select {levels}, bucket, complete, rest, n,
    sum(n) over (partition by {levels} order by md5('{SEED}|' || complete || '|' || bucket), bucket) as upto
  from buckets join plan using ({levels})
), taken as (
  select u.*, complete, rest, upto - n as before, upto,
    upto - n + sum(n_all) over (partition by {levels}, bucket order by md5('{SEED}|' || complete || '|' || k), k) as ends
  from units u join placed using ({levels}, bucket)
), chosen as (
  select k, {levels}, complete + case when case when before < rest and upto > rest then ends <= rest else rest > 0 and upto <= rest end
    then 1 else 0 end as times
  from taken
)
select doc_id, domain, lang, source, cast(unnest(range(0, times)) as int) as epoch, n_tokens
from d join chosen using (k, {levels})
"""


def _op9() -> str:
    places = " union all ".join(
        f"select r, unnest(range(0, greatest(len(w) - {len(p.split()) - 1}, 0))) as pos, w, {p.split()!r} as phrase, '{label}' as label from d"
        for p, label in PHRASES
    )
    grams = []
    for number, (label, text) in enumerate(TEMPLATES):
        w = text.split()
        grams += [f"({number}, '{label}', {len(w) - K + 1}, {len(w)}, {i}, '{' '.join(w[i : i + K])}')" for i in range(len(w) - K + 1)]
    return f"""
with d as (
  select row_number() over () as r, doc_id, {_WORDS} as w from documents
), base as (
  select r, pos, label from ({places}) where w[pos + 1 : pos + len(phrase)] = phrase
), based as (
  select r, count(*) as n_base, min(pos) as first_word, max(pos) as last_word from base group by 1
), t(template, label, grams, length, tpos, gram) as (
  values {", ".join(grams)}
), g as (
  select r, dpos, array_to_string(w[dpos + 1 : dpos + {K}], ' ') as gram
  from (select r, w, unnest(range(0, greatest(len(w) - {K - 1}, 0))) as dpos from d)
), votes as (
  select r, template, label, grams, length, dpos, tpos, dpos - tpos as diagonal from g join t using (gram)
), gaps as (
  select *, case when diagonal - lag(diagonal) over (partition by r, template order by diagonal, dpos) > {DRIFT} then 1 else 0 end as gap
  from votes
), regions as (
  select *, sum(gap) over (partition by r, template order by diagonal, dpos rows unbounded preceding) as region from gaps
), verified as (
  select r, label, min(dpos) as a, max(dpos) + {K} as b, count(distinct tpos + j) / greatest(length, max(dpos) + {K} - min(dpos)) as share
  from regions, range({K}) as k(j) group by r, template, label, length, region
  having share >= {MIN_SHARE} and max(dpos) + {K} - min(dpos) <= {MAX_STRETCH} * length
), spans as (
  select r, label, share from verified v
  where not exists (from verified o where o.r = v.r and o.share > v.share and o.a < v.b and v.a < o.b)
), labelled as (
  select r, string_agg(distinct label, ',' order by label) filter (is_base) as base_labels, string_agg(distinct label, ',' order by label) as labels
  from (select r, label, true as is_base from base union all select r, label, false from spans) group by 1
), best as (
  select r, max(share) as share from spans group by 1
)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  greatest(coalesce(share, 0.0::double), case when n_base > 0 then 0.5::double else 0.0::double end) as score
from d left join based using (r) left join labelled using (r) left join best using (r)
"""

def _repair() -> str:
    """Forward dynamic programme over rows; s0..s3 hold (cost, audit, repaired) of the four states."""
    blanks = "[\\x20\\x09-\\x0D]"

    def then(s: str, cost: str, letter: str, tail: str) -> str:
        return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 'r': {s}.r || {tail}}} END"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    insert_u = [then(f"s{i}", "3", "I", user) for i in (0, 1, 3)]
    body = "chr(10) || role || ':' || body"
    keep = lambda s, initial: f"CASE WHEN usable AND initial = '{initial}' THEN {then(s, 'more', 'K', body)} END"
    rerole = lambda s, role: f"CASE WHEN usable THEN {then(s, 'more + 3', 'R', f'{role} || body')} END"
    drop = lambda s: then(s, "4", "D", "''")
    into_user = [f(s, x) for s in ("s0", "t1", "t3") for f, x in ((keep, "u"), (rerole, user))]
    return f"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) FOR i IN range(256)] AS tab),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS bytes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, body, xor(list_reduce([4294967295::BIGINT] || bytes,
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind > 0),
ordered AS (
  SELECT *, substr(role, 1, 1) AS initial, row_number() OVER w AS i,
    lag(substr(role, 1, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, md5(length(role)::VARCHAR || ':' || role || body), copy)),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(body, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, body ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(body, '[.!?]{blanks}*$') THEN 'truncated' ELSE '' END AS fault
  FROM ordered),
costed AS (
  SELECT *, fault IN ('', 'truncated') AS usable, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM faults),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s1,
    NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, i, {drop('s0')}, {least(drop('t1'), keep('s0', 's'))},
    {least(drop('t2'), *into_user)}, {least(drop('t3'), keep('t2', 'a'), rerole('t2', assistant))}
  FROM (SELECT *, {least('s3', then('t2', '3', 'I', assistant))} AS t3
    FROM (SELECT c.*, s0, s1 AS t1, s3, {least('s2', *insert_u)} AS t2
      FROM walk w JOIN costed c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i + 1))),
ends AS (
  SELECT conv_id, {least('s0', 't3')} AS best
  FROM (SELECT conv_id, s0, {least('s3', then('t2', '3', 'I', assistant))} AS t3
    FROM (SELECT conv_id, s0, s3, {least('s2', *insert_u)} AS t2
      FROM walk QUALIFY i = max(i) OVER (PARTITION BY conv_id)))),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
  sha256(substr(best.r, 2)) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


REPAIR = _repair()


def oracle_sql() -> dict[str, str]:
    return {
        "op1_top_k": OP1, "op4_jaccard_join": OP4, "op5_warc": OP5, "op6_decontamination": OP6, "op8_mixing": _op8(),
        "op9_licenses": _op9(), "op12_repair": REPAIR,
    }
