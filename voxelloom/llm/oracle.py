"""SQL for another engine that gives the rows of queries that SQL can express."""

from __future__ import annotations

CHAT = r"""with c as (select cast(conv_id as bigint) as conv_id, cast(turn as bigint) as turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
  e as (select *, replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') as et,
    replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), ':' || chr(10), '\:' || chr(10)) as er,
    lag(role) over (partition by conv_id order by turn nulls first, role, text) as before, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(sum(case when role='assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role='assistant' then text end, '' order by n), '')) as loss_sha256,
  cast(sum(length(et)+8+case when n=1 or before<>role then length(er)+6 else 0 end) as bigint) as formatted_chars
from e group by conv_id"""

_DIGEST = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(h, {5 * k + 1}, 5) as bigint) >> {s}) & 31 as integer) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0))

WARC = f"""with p as (select cast(page_id as bigint) as page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
  m as (select *, max(page_id) over (partition by html) as head from p)
select page_id, octet_length(encode(html)) as payload_bytes, {_DIGEST} as payload_digest,
  case when page_id < head then 'revisit' else 'response' end as record_type, case when page_id < head then head end as refers_to from m"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": WARC, "op6_chat": CHAT}
