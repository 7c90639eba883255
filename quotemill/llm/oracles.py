"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

# What separates words, as in the contracts.
_SPACES = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{_SPACES}'), lambda x: x <> '')"


# Words have ASCII letters in lower case and these; with one byte for each, DuckDB's levenshtein counts letters.
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_SINGLE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"[: len(_ACCENTED)]


def _classes(n: int, percent: int, more: str) -> str:
    """Classes of documents whose sets of ``n``-word shingles are similar."""
    return f"""
with recursive worded as (
  select doc_id, {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
  from documents),
sets as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < {n} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) end) as s
  from worded),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b
  from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id
  join sizes na on na.doc_id = a.doc_id join sizes nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, na.n, nb.n
  having 100 * count(*) >= {percent} * (na.n + nb.n - count(*))),
reach(a, b) as (select doc_id, doc_id from sizes union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(c.component_id, d.doc_id) as component_id{more}
from worded d left join sizes using (doc_id)
left join (select a as doc_id, min(b) as component_id from reach group by a) c using (doc_id)
"""


ORACLE_SQL: dict[str, str] = {
    "op4_source_mixing": f"""
with docs as (
  select doc_id, source, len({_words("coalesce(text, '')")})::bigint as size,
         md5('mix|' || coalesce(doc_id::varchar, 'null')) as key
  from documents),
sizes as (select source, sum(size)::bigint as source_size from docs group by source),
named as (
  select *, row_number() over (order by source asc nulls last) as place,
         ((row_number() over (order by source asc nulls last) - 1) % 3 + 1)::double as weight,
         (3 * source_size)::double as most
  from sizes),
levels as (
  select *, (sum(source_size) over ()::double
             - coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by most / weight, place rows between current row and unbounded following) as level
  from named),
targets as (
  select *, least(most, weight * (select max(level) from levels where level * weight <= most)) as target,
         ceil(source_size / 32.0)::bigint as n_blocks
  from levels),
slotted as (
  select *, case when source_size > 0 then n_blocks * target / source_size else 0 end as slots from targets),
spans as (
  select place, source, source_size, target, n_blocks, slots,
         sum(slots) over (order by place rows between unbounded preceding and current row) as hi,
         sum(slots) over () as every
  from slotted),
edges as (
  select *, (hi - slots) / every as lo_u,
         case when place = max(place) filter (where slots > 0) over () then 2 else hi / every end as hi_u
  from spans where every > 0),
points as (
  select i, ((i::hugeint * 5566755282872655) % 9007199254740992)::double / 9007199254740992 as u
  from range(0, (select coalesce(max(round(every)), 0)::bigint from spans)) t(i)),
ranked as (
  select place, n_blocks, row_number() over (partition by place order by i) - 1 as rank
  from points join edges on u >= lo_u and u < hi_u and slots > 0),
times as (
  select place, rank % n_blocks as block, count(*) as times from ranked where rank // n_blocks < 3 group by all),
placed as (
  select d.doc_id, d.size, s.place, s.source_size, s.target, s.n_blocks,
         sum(d.size) over (partition by s.place order by ('0x' || substr(d.key, 1, 8))::bigint % 4096, d.key, d.size
                           rows between unbounded preceding and current row)::bigint - d.size as start,
         row_number() over () as id
  from docs d join spans s on d.source is not distinct from s.source),
pieces as (
  select *, unnest(range(((start + 1) * n_blocks - 1) // source_size, ((start + size) * n_blocks - 1) // source_size + 1)) as block
  from placed where size > 0),
used as (
  select id, sum((least(start + size, (block + 1) * source_size // n_blocks) - greatest(start, block * source_size // n_blocks))
                 * coalesce(times, 0))::bigint as taken
  from pieces left join times using (place, block) group by id)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from placed left join used using (id)
""",
    "op5_ngram_jaccard_join": _classes(5, 75, ""),
    "op6_line_dedup": f"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (
  select doc_id, i - 1 as line, row_number() over (partition by doc_id order by i) as pos, l[i] as content, len({_words("l[i]")}) as words
  from (select doc_id, l, unnest(range(1, len(l) + 1)) as i from split) where len({_words("l[i]")}) > 0),
-- All runs of all lengths of which every line is in two places; a line that is nowhere else ends them.
shared as (
  select * from lines where content in (select content from lines group by content having count(*) > 1)),
islands as (select *, pos - row_number() over (partition by doc_id order by pos) as island from shared),
runs as (
  select a.doc_id, a.pos, b.pos as upto, string_agg(c.content, chr(10) order by c.pos) as block, sum(c.words) as words
  from islands a join islands b on b.doc_id = a.doc_id and b.island = a.island and b.pos >= a.pos
  join islands c on c.doc_id = a.doc_id and c.pos between a.pos and b.pos
  group by a.doc_id, a.pos, b.pos having sum(c.words) >= 10),
firsts as (select *, min((doc_id, pos)) over (partition by block) as first from runs),
later as (select doc_id, pos, upto from firsts where (doc_id, pos) <> first),
gone as (
  select distinct l.doc_id, l.line from lines l join later r on r.doc_id = l.doc_id and l.pos between r.pos and r.upto),
listed as (select doc_id, count(*) as n_removed, string_agg(line::varchar, ',' order by line) as removed from gone group by doc_id)
select doc_id, len(l)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, coalesce(removed, '') as removed
from split left join listed using (doc_id)
""",
    "op11_spelling_variants": rf"""
-- The crc32 of each single byte, and then of each run byte by byte.
with recursive single as (
  select list(crc order by byte) as t
  from (select byte, list_reduce(list_prepend(byte::bigint, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as crc
        from range(256) u(byte))),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as uses
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as run from documents) where length(run) >= 7 group by all),
hashed as (
  select run, uses, xor(list_reduce(
           list_prepend(4294967295::bigint, list_transform(range(1, octet_length(encode(k)) + 1), lambda i: ('0x' || substr(hex(encode(k)), (2 * i - 1)::bigint, 2))::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
  from (select run, uses, coalesce(doc_id::varchar, '') || ':' || run as k from runs), single),
words as (
  select word, translate(word, '{_ACCENTED}', '{_SINGLE}') as letters, sum(uses)::bigint as n
  from (select uses, case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed)
  where length(word) >= 7 group by word having sum(uses) >= 2),
near as (
  select a.word, b.word as other, b.n as other_n from words a join words b
  on length(b.word) between length(a.word) - 1 and length(a.word) + 1 and a.word <> b.word
  where levenshtein(a.letters, b.letters) = 1),
best as (
  select word, count(*)::bigint as n_near, max(other_n) as top, arg_min(other, (-other_n, encode(other))) as other from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when top >= 10 * w.n then other end as form, case when top >= 10 * w.n then top end as form_n
  from words w left join best using (word)),
steps(word, reached, onward) as (
  select word, word, form from forms union all select s.word, f.word, f.form from steps s join forms f on f.word = s.onward)
select f.word, f.form, s.reached as root, f.n, f.n_near, f.form_n from forms f join steps s on s.word = f.word and s.onward is null
""",
    "op12_bottom_k_dedup": _classes(4, 80, ", coalesce(c.component_id, d.doc_id) = d.doc_id as kept"),
    "op13_hard_negatives": """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as vec
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, a.label as own, r.vec_id, r.label,
         list_sum(list_transform(list_zip(a.vec, r.vec), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::bigint as score
  from usable a join usable r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where label = own
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
  select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
         row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from positives p join scores s on s.anchor_id = p.anchor_id and s.label <> s.own
    and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 5
""",
}
