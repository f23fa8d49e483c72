"""DuckDB SQL for the named queries of this package that SQL can express."""

SQL: dict[str, str] = {}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACES = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

SQL["op5_benchmark_decontamination"] = rf"""
with split as (
    select 'd' as kind, doc_id as id,
           regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
    union all
    select 'b', item_id,
           regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    from benchmark
), windows as (
    select distinct id as item_id, n, array_to_string(w[i : i + n - 1], ' ') as words
    from (select id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
          from split where kind = 'b' and len(w) > 0)
), lengths as (select distinct n from windows),
starts as (
    select id, n, array_to_string(w[i : i + n - 1], ' ') as words, i
    from (select id, w, n, unnest(range(1, len(w) - n + 2)) as i
          from split, lengths where kind = 'd' and len(w) >= n)
), found as (select s.id, s.i, s.n, b.item_id from starts s join windows b using (n, words)),
hit as (
    select id, count(distinct pos) as n_hit
    from (select id, unnest(range(i, i + n)) as pos from found) group by id
), items as (
    select id, count(*) as n_items, string_agg(item, ',' order by item) as list
    from (select distinct id, item_id::varchar as item from found) group by id
)
select d.id as doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from split d left join hit using (id) left join items using (id)
where d.kind = 'd'
"""

SQL["op7_quality_rules"] = rf"""
with split as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents
), lines as (
    select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
    from (select doc_id, unnest(string_split(t, chr(10))) as line from split)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), grams as (
    select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from split)
), repeats as (
    select doc_id, count(distinct pos) as n_repeat_words
    from (select doc_id, unnest(range(i, i + 3)) as pos from grams where n > 1) group by doc_id
), counts as (
    select doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '{_SPACES}', '', 'g'))::bigint as word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) as upper_n, length(regexp_replace(t, '[^a-z]', '', 'g')) as lower_n,
           coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words
    from split left join lines using (doc_id) left join repeats using (doc_id)
), base as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 10 * n_dup_lines <= 3 * n_lines and 10 * n_symbols <= 3 * n_words
       and word_chars between 2 * n_words and 14 * n_words and upper_n <= lower_n as kept
from base
"""

SQL["op10_chat_formatting"] = """
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) v(t, r)
), written as (
    select *, replace(replace(text, '&', '&amp;'), '<', '&lt;') as text_out,
           replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;') as role_out
    from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('<|im_start|>' || role_out || chr(10) || text_out || '<|im_end|>' || chr(10)))::bigint as formatted_chars
from written group by conv_id
"""

SQL["op1_minhash_dedup"] = rf"""
with recursive split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORD}') as w from documents
), places as (
    select doc_id, w, least(4, len(w)) as n, unnest(range(1, len(w) - least(4, len(w)) + 2)) as i
    from split where len(w) > 0
), shingles as (select distinct doc_id, array_to_string(w[i : i + n - 1], ' ') as s from places),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as c
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
    select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * c >= 80 * (x.n + y.n - c)
), edges as (select a, b from links union all select b, a from links),
reach as (
    select doc_id as a, doc_id as b from split
    union
    select r.a, e.b from reach r join edges e on r.b = e.a
), least_of as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from split left join sizes using (doc_id) join least_of using (doc_id)
"""


def _clustering(k: int = 40, rounds: int = 5, dimensions: int = 64, scale: int = 256, seed: int = 2) -> str:
    """All distances of every round, with rounds written out one after the other."""
    steps = [
        f"""
vectors as (
    select vec_id, list_transform(embedding, lambda e: floor(e::double * {scale})::bigint) as v
    from embeddings
    where len(embedding) = {dimensions} and len(list_filter(embedding, lambda e: isfinite(e))) = {dimensions}
), numbered as (select vec_id, v, row_number() over () as id from vectors),
parts as (select id, unnest(range(1, {dimensions + 1})) as d, unnest(v) as x from numbered),
c0 as (
    select number, unnest(range(1, {dimensions + 1})) as d, unnest(v) as x
    from (select v, row_number() over (order by sha256('{seed}:' || vec_id::varchar), v) - 1 as number
          from vectors where vec_id is not null order by number limit {k})
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as (
    select id, arg_min(number, (distance, number)) as number, min(distance) as distance
    from (select p.id, c.number, sum((p.x - c.x) * (p.x - c.x)) as distance from parts p join c{r} c using (d) group by all)
    group by id
)""")
        if r < rounds:
            steps.append(f"""
m{r} as (
    select number, d, sum(x) as s, count(*) as n from parts join a{r} using (id) group by number, d
), c{r + 1} as (
    select number, d, coalesce((s - ((s % n) + n) % n) // n, x)::bigint as x from c{r} left join m{r} using (number, d)
)""")
    return f"""
with {",".join(steps)}, hashes as (
    select number, sha256(string_agg(x::varchar, ',' order by d)) as centroid_sha256 from c{rounds} group by number
)
select vec_id, number::int as cluster, distance::bigint as distance,
       sum(distance) over (partition by number)::bigint as cluster_inertia,
       sum(distance) over ()::bigint as inertia, centroid_sha256
from numbered join a{rounds} using (id) join hashes using (number)
"""


SQL["op13_centroid_clustering"] = _clustering()


def _repair() -> str:
    """Cheapest edits by forward steps: per conversation and row the best (cost, audit, rows) of each of four states."""

    def add(state: str, cost: str, letter: str, out: str = "''") -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {out}}}"

    def insert(state: str, role: str) -> str:
        return add(state, "5", "I", f"chr(10) || '{role}:'")

    def stay(state: str, role: str) -> str:
        """Kept as it is, or under another role."""
        kept = add(state, "extra", "K", "chr(10) || role || ':' || text")
        other = add(state, "1 + extra", "R", f"chr(10) || '{role}:' || text")
        return f"case when code = '{role[0]}' then {kept} else {other} end"

    never = "{'c': 1000000000::bigint, 'a': '', 'o': ''}"
    closed = f"""least(s2, {insert("s0", "user")}, {insert("s1", "user")}, {insert("s3", "user")}) as t2"""
    system = f"case when code = 's' then {add('s0', 'extra', 'K', 'chr(10) || role || chr(58) || text')} else {never} end"

    def free(choice: str) -> str:
        return f"case when code = 'D' then {never} else {choice} end"

    return rf"""
with recursive crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce(range(8), lambda acc, k: case when acc & 1 = 1 then xor(acc >> 1, 3988292384) else acc >> 1 end, i::bigint) as c
        from (select unnest(range(256)) as i)
    )
), filled as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint) as mark
    from conversations
), marked as (
    select conv_id, turn, role, text,
           xor(list_reduce(mark, lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295::bigint), 4294967295) % 20 as way
    from filled, crc_table
), damaged as (
    select conv_id, turn, case when way = 4 then 'user' else role end as role,
           case when way = 1 then '' when way = 2 then translate(text, '.!?', '') else text end as text,
           unnest(range(case when way = 3 then 2 else 1 end)) as copy
    from marked where way <> 0
), ids as (select conv_id, row_number() over () as id from (select distinct conv_id from conversations)),
placed as (
    select id, turn, role, text, row_number() over (partition by id order by turn nulls first, role, text) as i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
    from damaged d join ids on d.conv_id is not distinct from ids.conv_id
), judged as (
    select *, case when body = '' then 'blank'
                   when row_number() over (partition by id, role, text order by i) > 1 then 'duplicate'
                   when right(body, 1) not in ('.', '!', '?') then 'truncated' end as fault,
           left(role, 1) || lead(left(role, 1)) over (partition by id order by i) as pair
    from placed
), coded as (
    select id, i, role, text, case when fault = 'truncated' then 5 else 0 end as extra,
           case when fault in ('blank', 'duplicate') then 'D' else left(role, 1) end as code
    from judged
), facts as (
    select id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
           count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
           count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal, max(i) as n
    from judged group by id
), steps as (
    select id, 0::bigint as i, {{'c': 0::bigint, 'a': '', 'o': ''}} as s0, {never} as s1, {never} as s2, {never} as s3 from ids
    union all
    select id, i, {add("s0", "2", "D")}, least({add("s1", "2", "D")}, {system}),
           least({add("t2", "2", "D")}, {free(f"least({stay('s0', 'user')}, {stay('s1', 'user')}, {stay('t3', 'user')})")}),
           least({add("t3", "2", "D")}, {free(stay("t2", "assistant"))})
    from (
        select *, least(s3, {insert("t2", "assistant")}) as t3 from (
            select s.id, c.i, s0, s1, s3, role, text, extra, code, {closed}
            from steps s join coded c on s.id = c.id and c.i = s.i + 1
        )
    )
), ended as (
    select id, least(s0, s3, {insert("t2", "assistant")}) as best
    from (select id, s0, s3, {closed} from steps join ids using (id) left join facts using (id) where i = coalesce(n, 0))
)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, best.c::bigint as cost, best.a as audit,
       sha256(best.o[2:]) as repaired_sha256
from ids join ended using (id) left join facts using (id)
"""


SQL["op12_conversation_repair"] = _repair()
