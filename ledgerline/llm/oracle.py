"""Operators that SQL can say, over the same tables."""

from __future__ import annotations

_INTEGERS = """
  kept as (
    select row_number() over (order by vec_id) as r, vec_id, label,
      list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
  parts as (
    select r, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) as x
    from kept, (select unnest(range(16)) as p)),
  book0 as (select p, r - 1 as e, x from parts where r <= 64)"""


def _nearest(book: str) -> str:
    """The nearest entry of each part, ties to the lower index, and its squared distance."""
    return f"""
      select r, p, e, d, x from (
        select r, p, e, d, x, row_number() over (partition by r, p order by d, e) as k from (
          select a.r, a.p, b.e, a.x, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
          from parts a join {book} b on a.p = b.p)) where k = 1"""


def _updated(book: str, near: str) -> str:
    """Entries as the floors of the means of their parts; unused ones stay."""
    return f"""
      select b.p, b.e, coalesce(m.x, b.x) as x from {book} b left join (
        select p, e, list(f order by i) as x from (
          select p, e, i, cast(floor(cast(sum(c) as double) / count(*)) as bigint) as f
          from (select p, e, unnest(x) as c, generate_subscripts(x, 1) as i from {near}) group by p, e, i)
        group by p, e) m on m.p = b.p and m.e = b.e"""


VECTOR_CODES = f"""
with {_INTEGERS},
  near0 as ({_nearest('book0')}), book1 as ({_updated('book0', 'near0')}),
  near1 as ({_nearest('book1')}), book2 as ({_updated('book1', 'near1')}),
  near2 as ({_nearest('book2')}),
  coded as (
    select r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by p) as code, cast(sum(d) as bigint) as error from near2 group by r),
  digest as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256 from book2),
  labels as (select label, cast(sum(error) as bigint) as label_error from kept join coded on coded.r = kept.r group by label)
select kept.vec_id, code, error, label_error, codebooks_sha256
from kept join coded on coded.r = kept.r join labels on labels.label is not distinct from kept.label, digest"""


# crc32 byte by byte: the table's entries come from eight steps of its polynomial each.
_CRC_TABLE = """
  steps as (
    select list(c order by n) as steps from (
      select n, list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
      from (select unnest(range(256)) as n)))"""

SPELLINGS = f"""
with recursive {_CRC_TABLE},
  runs as (
    select doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as c
    from (select coalesce(cast(doc_id as varchar), '') as doc, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) as run from documents) group by all),
  spelled as (select run, c, hex(encode(doc || ':' || run)) as h from runs),
  bytes as (
    select run, c, list_transform(range(0, len(h) // 2),
      lambda i: cast((instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 as bigint)) as b
    from spelled),
  hashed as (
    select run, c, xor(list_reduce(list_prepend(cast(4294967295 as bigint), b), lambda s, x: xor(s >> 8, steps[(xor(s, x) & 255) + 1])), 4294967295) as h
    from bytes, steps),
  words as (
    select word, cast(sum(c) as bigint) as n from (
      select c, case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed)
    where length(word) >= 7 group by word having sum(c) >= 2),
  holes as (
    select word, n, length(word) as l, i, substr(word, 1, i) || substr(word, i + 2) as rest
    from (select word, n, unnest(range(length(word))) as i from words)),
  pairs as (
    select a.word, b.word as near, b.n as near_n from holes a join holes b on a.rest = b.rest and a.i = b.i and a.l = b.l and a.word <> b.word
    union select a.word, b.word, b.n from holes a join words b on a.rest = b.word
    union select b.word, a.word, a.n from holes a join words b on a.rest = b.word),
  best as (
    select word, near, near_n, count(*) over (partition by word) as n_near, row_number() over (partition by word order by near_n desc, near) as k from pairs),
  formed as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * w.n then near end as form, case when near_n >= 10 * w.n then near_n end as form_n
    from words w left join (select * from best where k = 1) b on b.word = w.word),
  chain as (
    select word, word as root, 0 as step from formed
    union all select c.word, f.form, c.step + 1 from chain c join formed f on f.word = c.root where f.form is not null),
  roots as (select word, root from (select word, root, row_number() over (partition by word order by step desc) as k from chain) where k = 1)
select f.word, n, form, form_n, root, n_near from formed f join roots r on r.word = f.word"""


def oracle_sql() -> dict[str, str]:
    return {"op12_spellings": SPELLINGS, "op13_vector_codes": VECTOR_CODES}
