"""The queries of ``queries.py`` in DuckDB SQL over the same tables."""

from __future__ import annotations

from checks.views import CAMERAS, RECIPE
from episodica.functions import fixed as K


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fmt(template: str, *args: str) -> str:
    """A message template as a SQL expression."""
    parts = template.replace("%s", "%d").split("%d")
    out = [q(parts[0])]
    for arg, rest in zip(args, parts[1:]):
        out += [f"cast({arg} as varchar)", q(rest)]
    return "(" + " || ".join(out) + ")"


# --- views ---------------------------------------------------------------------------------

CAMS = f"cameras as (select * from (values ({q(CAMERAS[0])}, 0), ({q(CAMERAS[1])}, 1)) t(camera, rank))"
ORDER_SPLITS = """splits as (
  select 'train' as split, 0 as lo, (count(*) * 8) // 10 as hi from orders
  union all select 'val', (count(*) * 8) // 10, (count(*) * 9) // 10 from orders
  union all select 'test', (count(*) * 9) // 10, count(*) from orders)"""
CONV_SPLITS = """splits as (
  select 'train' as split, 0 as lo, ((max(conv_id) + 1) * 8) // 10 as hi from conversations
  union all select 'val', ((max(conv_id) + 1) * 8) // 10, ((max(conv_id) + 1) * 9) // 10 from conversations
  union all select 'test', ((max(conv_id) + 1) * 9) // 10, max(conv_id) + 1 from conversations)"""
CONV_BASE = """conv_base as (
  select conv_id as ep, turn as step0, conv_id * 1000 + turn as ord,
    turn = max(turn) over (partition by conv_id) as is_last, text as said
  from conversations)"""
LINE_BASE = """line_base as (
  select l_orderkey as ep, rn - 1 as step0, l_orderkey * 100 + rn - 1 as ord, rn = n as is_last,
    cast(l_quantity as float) as quantity, cast(l_extendedprice as float) as price,
    cast(l_discount as float) as discount, cast(l_tax as float) as tax
  from (select *,
      row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate) as rn,
      count(*) over (partition by l_orderkey) as n
    from lineitem))"""


def recipe(name: str, base: str) -> str:
    columns = ", ".join(f"{e} as {n}" for n, e in RECIPE.items())
    return f"{name} as (select ep as episode_index, {columns} from {base})"


CONV_STEPS = f"{CONV_BASE}, {recipe('conv_steps', 'conv_base')}"
LINE_STEPS = f"{LINE_BASE}, {recipe('line_steps', 'line_base')}"
REPEATED = f"""{LINE_STEPS}, repeated_steps as (
  select * replace (case when episode_index % 3 = 0 then 7 else episode_index // 10 end as "index") from line_steps)"""
EVENT_STEPS = """event_steps as (
  select user_id as episode_index, row_number() over (partition by user_id order by event_id) - 1 as frame_index,
    event_type = 'purchase' as done, event_id as "index"
  from events)"""
META = """episodes_meta as (
  select o_orderkey as episode_index,
    coalesce(n, 0) + case when o_orderkey % 97 = 0 then 1 else 0 end as length
  from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on o_orderkey = l_orderkey)"""
LINE_STORE = f"""{LINE_BASE}, {ORDER_SPLITS}, {CAMS}, step_rows as (
  select split, ep, step0, is_last, ord, quantity, price, discount, tax,
    row_number() over (partition by split order by ord) - 1 as "row"
  from line_base join splits on ep >= lo and ep < hi),
line_store as (
  select split, camera, "row", ep as episode_idx, step0 as step_idx, is_last as done,
    cast(step0 / 10 as float) as "timestamp", ord as "index", ep % 7 as task_index,
    quantity, price, discount, tax, false as no_action, 3 as channels
  from step_rows, cameras)"""
LINE_INDEX = f"""line_index as (
  select split, ep_pos, episode_index, ep_len,
    cast(coalesce(sum(ep_len) over (partition by split order by ep_pos
      rows between unbounded preceding and 1 preceding), 0) as bigint) as ep_offset
  from (select split, l_orderkey as episode_index, count(*) as ep_len,
      row_number() over (partition by split order by l_orderkey) - 1 as ep_pos
    from lineitem join splits on l_orderkey >= lo and l_orderkey < hi group by split, l_orderkey))"""
BAD_STORE = f"""{LINE_STORE}, {LINE_INDEX}, bad_store as (
  select split, camera, "row", episode_idx,
    step_idx + case when episode_idx % 79 = 4 then 1 else 0 end as step_idx,
    case when episode_idx % 83 = 7 then false when episode_idx % 89 = 3 and step_idx = 0 then true else done end as done,
    "row" % 1009 = 5 as no_action, case when camera = {q(CAMERAS[1])} then 2 else 3 end as channels
  from line_store),
bad_index as (
  select split, ep_pos, episode_index,
    case when ep_pos = 60 then -2 when ep_pos = 61 then -100000 when ep_pos % 97 = 0 then ep_len + 1
      when ep_pos % 101 = 1 then 0 else ep_len end as ep_len,
    case when ep_pos = max(ep_pos) over (partition by split) then ep_offset + 5 when ep_pos = 0 then 1
      when ep_pos = 50 then ep_offset - 7 else ep_offset end as ep_offset
  from line_index)"""
PIXELS = """pixel_rows as (
  select vec_id, 'unit' as copy, embedding as v from embeddings
  union all
  select vec_id, 'scaled', list_transform(embedding, lambda x: x * cast(1000 as float)) from embeddings),
bytes as (
  select vec_id, copy, list_transform(v, lambda x: cast(trunc(least(greatest(
    x * cast(case when list_max(v) <= 1 then 255 else 1 end as float), 0), 255)) as integer)) as b
  from pixel_rows)"""

# --- quality -------------------------------------------------------------------------------


def runs(view: str, split: str = "", order: str = '"index"', rank: str = '"index"') -> str:
    """CTE ``runs`` of a view; ``split`` names the column of splits that are checked apart.

    ``order`` is the order of the rows, ``rank`` one number or struct that says the same inside a run.
    """
    by, also = (f"partition by {split}", f"{split}, ") if split else ("", "")
    return f"""marked as (
  select *, lag(episode_index) over ({by} order by {order}) as pe, lag(frame_index) over ({by} order by {order}) as ps
  from {view}),
opened as (select *, case when pe is null or pe <> episode_index then 1 else 0 end as o from marked),
numbered as (select *, sum(o) over ({by} order by {order} rows unbounded preceding) as run from opened),
folded as (
  select {also}episode_index, run, min("index") as run_start, max("index") as run_end, count(*) as n_rows,
    arg_min(frame_index, {rank}) as first_step, bool_or(o = 0 and frame_index <> ps + 1) as step_gap,
    arg_max(done, {rank}) as last_done, count(*) filter (where done) as n_done
  from numbered group by {also}episode_index, run),
runs as (
  select * exclude (run), row_number() over (partition by {also}episode_index order by run_start) > 1 as again
  from folded)"""


def issues(view: str, terminal: bool = True, split: str = "") -> str:
    also = f"{split}, " if split else ""
    which = f"select {also}episode_index, run_start"
    parts = [
        f"{which}, 0 as seq, {q(K.NOT_CONTIGUOUS)} as message from runs where again",
        f"{which}, 1, {fmt(K.STARTS_AT, 'first_step')} from runs where first_step <> 0",
        f"{which}, 2, {q(K.STEP_GAP)} from runs where step_gap",
    ]
    if terminal:
        parts.append(f"{which}, 3, {q(K.NOT_TERMINATED)} from runs where not last_done")
    parts.append(
        f"{which}, 4, {q(K.EARLY_DONE)} from runs"
        " where n_done > case when last_done then 1 else 0 end"
    )
    body = " union all ".join(parts)
    return f"{runs(view, split)}, issues as (select * replace (cast(seq as bigint) as seq) from ({body}))"


ISSUE_ROWS = "select episode_index, run_start, seq, message from issues"
ISSUE_LISTS = """select episode_index, ordinal // 20 as part, string_agg(message, '; ' order by ordinal) as issues
from (select *, row_number() over (partition by episode_index order by run_start, seq) - 1 as ordinal from issues)
group by 1, 2"""
RUN_ROWS = "select episode_index, run_start, run_end, n_rows, first_step, step_gap, last_done, n_done, again from runs"


def counts(name: str, ctes: str, view: str) -> str:
    return (
        f"select * from (with {ctes}, {issues(view)} select seq, count(distinct episode_index) as episodes,"
        f" '{name}' as view from issues group by seq)"
    )


SPLIT_ISSUES = f"""{LINE_STEPS}, {ORDER_SPLITS}, split_steps as (
  select * from line_steps join splits on episode_index >= lo and episode_index < hi),
{issues("split_steps", split="split")}, status as (
  select split, o_orderkey as episode_index, (split, o_orderkey) not in (select (split, episode_index) from issues) as valid
  from orders join splits on o_orderkey >= lo and o_orderkey < hi)"""


def summary(action: str, kept: str) -> str:
    return f"""with {SPLIT_ISSUES} select split, count(*) as requested_episode_count,
  min(episode_index) as first_requested, max(episode_index) as last_requested,
  count(*) filter (where not valid) as invalid_episode_count, {kept} as kept_episode_count,
  case when count(*) filter (where not valid) > 0 then '{action}' else 'kept_all' end as action_taken
from status group by split"""


# --- validation ------------------------------------------------------------------------------


def validate(store: str, index: str, strict: bool = True, short: str | None = None, channels: bool = True) -> str:
    """CTE ``messages`` for a store (with no_action and channels) and an episode table."""
    strict_parts = f"""
  union all select split, camera, ep_pos, 15, {fmt(K.SLICE_TERMINAL, "ep_pos")} from seen
    where ep_len > 0 and found = ep_len and not ends_done
  union all select split, camera, ep_pos, 16, {fmt(K.SLICE_EARLY, "ep_pos")} from seen
    where ep_len > 0 and found = ep_len and early_done"""
    return f"""stores as (
  select split, camera, count(*) as n_rows, count(*) filter (where not no_action) as n_action,
    max(channels) as channels
  from {store} group by 1, 2),
idx as (
  select split, count(ep_len) as n_len, count(ep_offset) as n_offset, arg_min(ep_offset, ep_pos) as first_offset,
    bool_or(ep_len <= 0) as non_positive, bool_or(ep_offset < before) as decreases, sum(ep_len) as sum_len
  from (select *, lag(ep_offset) over (partition by split order by ep_pos) as before from {index}) group by 1),
whole as (select * from stores left join idx using (split)),
slices as (
  select split, camera, ep_pos, ep_len, ep_offset, ep_offset + ep_len as stop, n_rows
  from {index} join stores using (split)),
fitting as (select * from slices where ep_offset >= 0 and stop <= n_rows),
matched as (
  select f.split, f.camera, f.ep_pos, f.ep_len, f.ep_offset, s."row", s.step_idx, s.episode_idx, s.done
  from fitting f join {store} s on s.split = f.split and s.camera = f.camera
    and s."row" >= f.ep_offset and s."row" < f.stop),
grouped as (
  select split, camera, ep_pos, count(*) as n, bool_or(step_idx <> "row" - ep_offset) as bad_steps,
    count(distinct episode_idx) > 1 as mixed, bool_or(done and "row" = ep_offset + ep_len - 1) as ends_done,
    bool_or(done and "row" < ep_offset + ep_len - 1) as early_done
  from matched group by 1, 2, 3),
seen as (
  select f.*, g.bad_steps, g.mixed, g.ends_done, g.early_done,
    case when ep_len >= 0 then coalesce(g.n, 0)
      else greatest(case when stop < 0 then greatest(stop + n_rows, 0) else stop end - ep_offset, 0) end as found
  from fitting f left join grouped g using (split, camera, ep_pos)),
messages as (
  select split, camera, -1 as ep_pos, 2 as "check",
    {fmt(K.LENGTH_MISMATCH, "'''action'': ' || n_action")} as message from whole where n_action <> n_rows
  union all select split, camera, -1, 4, {fmt(K.PIXELS_CHANNELS, "channels")} from whole where channels not in (1, 3)
  union all select split, camera, -1, 6, {fmt(K.INDEX_LENGTHS, "n_len", "n_offset")} from whole where n_len <> n_offset
  union all select split, camera, -1, 7, {fmt(K.FIRST_OFFSET, "first_offset")} from whole where first_offset <> 0
  union all select split, camera, -1, 8, {q(K.NON_POSITIVE_LEN)} from whole where non_positive
  union all select split, camera, -1, 9, {q(K.OFFSETS_DECREASE)} from whole where decreases
  union all select split, camera, -1, 10, {fmt(K.TOTAL_ROWS, "coalesce(sum_len, 0)", "n_rows")} from whole
    where coalesce(sum_len, 0) <> n_rows
  union all select split, camera, ep_pos, 11, {fmt(K.SLICE_BOUNDS, "ep_pos", "ep_offset", "stop", "n_rows")} from slices
    where ep_offset < 0 or stop > n_rows
  union all select split, camera, ep_pos, 12, {fmt(K.SLICE_ROWS, "ep_pos", "ep_len", "found")} from seen
    where found <> ep_len
  union all select split, camera, ep_pos, 13, {fmt(K.SLICE_STEPS, "ep_pos", "ep_len - 1")} from seen
    where ep_len > 0 and found = ep_len and bad_steps
  union all select split, camera, ep_pos, 14, {fmt(K.SLICE_MIXED, "ep_pos")} from seen
    where found = ep_len and (ep_len = 0 or mixed){strict_parts if strict else ""})"""


MESSAGE_ROWS = 'select split, camera, cast(ep_pos as bigint) as ep_pos, cast("check" as bigint) as "check", message from messages'
VERDICTS = """select s.split, s.camera, n is null as valid, coalesce(n, 0) as n_errors
from stores s left join (select split, camera, count(*) as n from messages group by 1, 2) m
  on m.split = s.split and m.camera = s.camera"""
MISSING = K.MISSING_KEYS % ["proprio", "timestamp", "ep_offset"]

FRAMES = f"""{LINE_STORE}, {LINE_INDEX}, per as (
  select split, camera, ep_pos, episode_index, ep_len, ep_offset, ep_len as expected,
    ep_len + (episode_index * 7 + rank) % 3 - 1 as decoded
  from line_index, cameras)"""

TEXT_FRAMES = """files as (
  select doc_id as episode_index, hex(encode(text)) as h, octet_length(encode(text)) as n,
    case when regexp_matches(text, '^[A-Z]') then 'any' else 'lower' end as decoder
  from documents),
frames as (
  select episode_index, k as frame_pos, decoder, rpad(substr(h, cast(k * 128 + 1 as bigint), 128), 128, '20') as bytes
  from files, lateral (select unnest(range(0, (n + 63) // 64)) as k))"""

# --- conversion of the conversations -----------------------------------------------------------

CONVERTED = f"""{CONV_BASE}, {CONV_SPLITS}, {CAMS}, steps as (
  select ep, step0, {RECIPE["frame_index"]} as frame_index, {RECIPE["done"]} as done, {RECIPE["index"]} as "index",
    length(said) as size
  from conv_base),
conv_steps as (select split, ep as episode_index, frame_index, done, "index" from steps join splits on ep >= lo and ep < hi)"""


def converted(kept: str) -> str:
    """Store of the kept conversations; frames sit at slice offset + k, whatever row that is."""
    return f"""kept as (select distinct split, ep from steps join splits on ep >= lo and ep < hi {kept}),
placed as (
  select k.split, s.*, row_number() over (partition by k.split order by "index") - 1 as "row"
  from steps s join kept k using (ep)),
lens as (select split, ep, count(*) as ep_len, row_number() over (partition by split order by ep) - 1 as ep_pos
  from placed group by 1, 2),
conv_index as (select *, ep as episode_index, cast(coalesce(sum(ep_len) over (partition by split order by ep_pos
    rows between unbounded preceding and 1 preceding), 0) as bigint) as ep_offset from lens)"""


ORACLE = {
    "q1_source_issues_conversations": f"with {CONV_STEPS}, {issues('conv_steps')} {ISSUE_ROWS}",
    "q1_source_issues_lines": f"with {LINE_STEPS}, {issues('line_steps')} {ISSUE_ROWS}",
    "q1_source_issues_events": f"with {EVENT_STEPS}, {issues('event_steps')} {ISSUE_ROWS}",
    "q1_without_terminal_done": f"with {LINE_STEPS}, {issues('line_steps', terminal=False)} {ISSUE_ROWS}",
    "q1_check_counts": " union all ".join(
        [
            counts("conv", CONV_STEPS, "conv_steps"),
            counts("line", LINE_STEPS, "line_steps"),
            counts("event", EVENT_STEPS, "event_steps"),
        ]
    ),
    "w1_a4_runs": f"with {LINE_STEPS}, {runs('line_steps')} {RUN_ROWS}",
    "w1_runs_interleaved": f"with {EVENT_STEPS}, {runs('event_steps')} {RUN_ROWS}",
    "a5_issue_lists_conversations": f"with {CONV_STEPS}, {issues('conv_steps')} {ISSUE_LISTS}",
    "a5_issue_lists_lines": f"with {LINE_STEPS}, {issues('line_steps')} {ISSUE_LISTS}",
    "a5_issue_lists_events": f"with {EVENT_STEPS}, {issues('event_steps')} {ISSUE_LISTS}",
    "j1_p8_drop_dirty": f"""with {LINE_STEPS}, {issues('line_steps')}
select episode_index, frame_index, done, "index" from line_steps
where episode_index not in (select episode_index from issues)""",
    "p8_warn_policy": "select l_orderkey % 10 as bin, count(*) as n from lineitem group by 1",
    "a6_split_summary": summary("drop_invalid", "count(*) filter (where valid)"),
    "a6_split_summary_warn": summary("warn_only", "count(*)"),
    "a6_episode_status": f"with {SPLIT_ISSUES} select split, episode_index, valid, valid as kept from status",
    "f5_parse_range": """with specs as (
  select o_orderkey, case when o_orderkey % 11 = 3 then cast(o_orderkey as varchar)
    when o_orderkey % 11 = 5 then o_orderkey || ':x' when o_orderkey % 11 = 7 then ':' || o_orderkey
    else (o_orderkey - 2) || ':' || (o_orderkey + o_custkey % 7 - 4) end as spec,
    (select (count(*) * 9) // 10 from orders) as total
  from orders),
parts as (select *, try_cast(split_part(spec, ':', 1) as bigint) as a, try_cast(split_part(spec, ':', 2) as bigint) as b from specs),
judged as (select *, case when not contains(spec, ':') then 'no colon' when a is null or b is null then 'not a number'
  when a < 0 or b < 0 then 'negative' when b < a then 'end before start' when b > total then 'beyond total' else 'ok' end as status
  from parts)
select o_orderkey, spec, case when status = 'ok' then a end as start, case when status = 'ok' then b end as "end", status
from judged""",
    "p5_select_split": f"""with {ORDER_SPLITS} select split, count(*) as n, min(l_orderkey) as low, max(l_orderkey) as high
from lineitem join splits on l_orderkey >= lo and l_orderkey < hi group by 1""",
    "j7_assign_splits": f"""with {LINE_STEPS}, {ORDER_SPLITS}, more as (
  select * from splits union all select 'half', max(hi) // 4, max(hi) // 4 * 3 from splits)
select split, episode_index, "index" from line_steps join more on episode_index >= lo and episode_index < hi""",
    "j2_camera_fan_out": f"""with {LINE_BASE}, {CAMS}
select camera, ep as episode_index, step0 as frame_index, ord as "index" from line_base, cameras""",
    "w6_row_position_repeated": f"""with {REPEATED} select episode_index, frame_index, "index",
  row_number() over (order by "index", episode_index, frame_index) - 1 as "row" from repeated_steps""",
    "w1_runs_repeated": f"""with {REPEATED}, {runs('repeated_steps', order='"index", episode_index, frame_index',
        rank='struct_pack(a := "index", b := frame_index)')} {RUN_ROWS}""",
    "t1_transitions": f"""with {LINE_BASE}, vectors as (
  select ep as episode_index, {RECIPE['frame_index']} as frame_index, quantity, price, discount, tax from line_base),
paired as (select *, lead(frame_index) over w as next_frame, lead(quantity) over w as q1, lead(price) over w as p1,
    lead(discount) over w as d1, lead(tax) over w as t1
  from vectors window w as (partition by episode_index order by frame_index))
select episode_index, frame_index, next_frame, cast(quantity as double) as state_0, cast(price as double) as state_1,
  cast(discount as double) as state_2, cast(tax as double) as state_3, cast(q1 as double) as next_state_0,
  cast(p1 as double) as next_state_1, cast(d1 as double) as next_state_2, cast(t1 as double) as next_state_3,
  cast(quantity as double) as action_0, cast(discount as double) as action_1
from paired where next_frame is not null""",
    "t2_goal_topk": """with distances as (
  select g.vec_id as goal_id, e.vec_id, list_sum(list_transform(list_zip(e.embedding, g.embedding),
    lambda x: (cast(x[1] as double) - x[2]) * (cast(x[1] as double) - x[2]))) as distance
  from embeddings g, embeddings e where g.vec_id % 100 = 0)
select goal_id, row_number() over (partition by goal_id order by distance, vec_id) as rank, vec_id, round(distance, 6) as distance
from distances qualify rank <= 10""",
    "t3_normalise_channels": f"""with {PIXELS}, flat as (
  select vec_id, copy, unnest(list_concat(b, list_reverse(b), b)) as v, unnest(range(192)) as pos from bytes)
select vec_id, copy, pos, round((cast(v as double) / 255 - case pos % 3 when 0 then {K.CHANNEL_MEAN[0]} when 1 then {K.CHANNEL_MEAN[1]}
  else {K.CHANNEL_MEAN[2]} end) / case pos % 3 when 0 then {K.CHANNEL_STD[0]} when 1 then {K.CHANNEL_STD[1]} else {K.CHANNEL_STD[2]} end, 9) as value
from flat""",
    "w6_row_position": f"""with {LINE_STEPS}
select episode_index, "index", row_number() over (order by "index") - 1 as "row" from line_steps""",
    "w6_row_position_per_split": f"""with {LINE_STEPS}, {ORDER_SPLITS}
select split, episode_index, "index", row_number() over (partition by split order by "index") - 1 as "row"
from line_steps join splits on episode_index >= lo and episode_index < hi""",
    "a1_lengths_declared": f"with {META} select episode_index, length as ep_len from episodes_meta",
    "a1_lengths_from_bounds": "select l_orderkey as episode_index, count(*) as ep_len from lineitem group by 1",
    "w2_o2_episode_offsets": f"with {ORDER_SPLITS}, {LINE_INDEX} select split, ep_pos, episode_index, ep_len, ep_offset from line_index",
    "j5_episode_metadata": f"""with {META}, wanted as (select distinct l_orderkey + 50 as episode_index from lineitem)
select episode_index, length as ep_len from wanted left join episodes_meta using (episode_index)""",
    "j5_missing_metadata": """select distinct l_orderkey + 50 as episode_index from lineitem
where l_orderkey + 50 not in (select o_orderkey from orders)""",
    "j6_reconcile": f"""with {META}, actual as (select l_orderkey as episode_index, count(*) as n from lineitem group by 1)
select episode_index, coalesce(length, 0) as declared, coalesce(n, 0) as actual
from episodes_meta full join actual using (episode_index) where coalesce(length, 0) <> coalesce(n, 0)""",
    "j3_assign_slices": f"""with {BAD_STORE}
select r.split, i.ep_pos, r."row", r.ep as episode_idx from step_rows r join bad_index i
  on r.split = i.split and r."row" >= i.ep_offset and r."row" < i.ep_offset + i.ep_len""",
    "v_validate_clean": f"with {LINE_STORE}, {LINE_INDEX}, {validate('line_store', 'line_index')} {VERDICTS}",
    "v_validate_bad": f"with {BAD_STORE}, {validate('bad_store', 'bad_index')} {MESSAGE_ROWS}",
    "v_validate_not_strict": f"""with {BAD_STORE}, {validate('bad_store', 'bad_index', strict=False)}
select split, camera, cast("check" as bigint) as "check", count(*) as n from messages group by 1, 2, 3""",
    "v1_validate_missing_columns": f"""with {LINE_STORE}
select distinct split, camera, cast(-1 as bigint) as ep_pos, cast(1 as bigint) as "check", {q(MISSING)} as message from line_store""",
    "a8_any_error": f"with {BAD_STORE}, {validate('bad_store', 'bad_index')} select count(*) > 0 as any_error from messages",
    "a2_inspect_declared": f"""with {BAD_STORE} select s.split, s.camera, i.num_episodes, i.total_steps
from (select distinct split, camera from bad_store) s
left join (select split, count(ep_len) as num_episodes, cast(sum(ep_len) as bigint) as total_steps from bad_index group by 1) i
  using (split)""",
    "a2_inspect_rows": f"""with {LINE_STORE} select split, camera, count(distinct episode_idx) as num_episodes,
  count(*) as total_steps from line_store group by 1, 2""",
    "a3_inspect_columns": f"""with {BAD_STORE}, per as (
  select split, camera, count(*) as n, count(*) filter (where not no_action) as na, max(channels) as c from bad_store group by 1, 2),
cells as (
  select split, camera, 'action' as "column", 'float32' as dtype, na as n_values, '[' || na || ', 2]' as shape from per
  union all select split, camera, "column", 'float32', n, '[' || n || ', 4]' from per, (values ('state'), ('proprio')) t("column")
  union all select split, camera, 'pixels', 'uint8', n, '[' || n || ', 1, 1, ' || c || ']' from per
  union all select split, camera, 'done', 'bool', n, '[' || n || ']' from per
  union all select split, camera, 'timestamp', 'float32', n, '[' || n || ']' from per
  union all select split, camera, "column", 'int64', n, '[' || n || ']' from per,
    (values ('episode_idx'), ('step_idx'), ('index'), ('task_index')) t("column")
  union all select per.split, per.camera, "column", 'int64', m, '[' || m || ']' from per
    join (select split, count(*) as m from line_index group by 1) using (split), (values ('ep_len'), ('ep_offset')) t("column"))
select split, camera, "column", dtype, n_values, shape from cells""",
    "s7_written_store": f"""with {LINE_STORE} select split, camera, "row", episode_idx, step_idx, done,
  cast("timestamp" as double) as "timestamp", "index", task_index, cast(quantity as double) as action_0,
  cast(price as double) as proprio_1, cast(tax as double) as state_3, lpad(hex("row"), 6, '0') as colour
from line_store""",
    "s13_written_episode_table": f"with {ORDER_SPLITS}, {LINE_INDEX}, {CAMS} select split, camera, ep_pos, episode_index, ep_len, ep_offset from line_index, cameras",
    "s7_cameras_apart": f"""with {LINE_STORE}, kept as (
  select split, camera, episode_idx from line_store where camera = {q(CAMERAS[0])} or episode_idx % 3 <> 0)
select split, camera, true as valid, cast(0 as bigint) as n_errors, count(distinct episode_idx) as num_episodes, count(*) as total_steps
from kept group by 1, 2""",
    "v1_stored_without_action": f"""with {LINE_STORE}
select distinct split, camera, cast(-1 as bigint) as ep_pos, cast(1 as bigint) as "check",
  'Missing required keys: [''action'']' as message from line_store""",
    "a2_stored_without_index": f"""with {LINE_STORE} select split, camera, count(distinct episode_idx) as num_episodes,
  count(*) as total_steps from line_store where camera = {q(CAMERAS[1])} group by 1, 2""",
    "s6_s12_written_attributes": f"""with {LINE_STORE} select split, camera, 'tables/lineitem' as source_repo_id,
  split as source_split, camera as source_camera_key, cast(10 as bigint) as fps, count(*) as n_rows
from line_store group by 1, 2""",
    "p10_p11_selected_episode": f"""with {LINE_STORE}, {LINE_INDEX}
select s.split, s.camera, s."row", s.episode_idx, s.step_idx, i.ep_offset from line_store s join line_index i
  on s.split = i.split and s."row" >= i.ep_offset and s."row" < i.ep_offset + i.ep_len
where s.split = 'val' and s.camera = {q(CAMERAS[1])} and i.ep_pos = 7""",
    "s1_p1_p2_read_steps": f"""with {LINE_BASE} select ep as episode_index, step0 as frame_index, is_last as done,
  cast(cast(step0 / 10 as float) as double) as "timestamp", ord as "index", ep % 7 as task_index,
  cast(discount as double) as action_1, cast(price as double) as state_1 from line_base""",
    "s1_read_steps_of_split": f"""with {LINE_BASE}, {ORDER_SPLITS}
select ep as episode_index, step0 as frame_index, is_last as done, split from line_base
join splits on ep >= lo and ep < hi where split = 'val'""",
    "s2_dataset_info": f"""with {ORDER_SPLITS}, {CAMS} select camera, split, count(*) as n_rows,
  cast(8 as bigint) as height, cast(8 as bigint) as width, cast(3 as bigint) as channels
from lineitem join splits on l_orderkey >= lo and l_orderkey < hi, cameras group by 1, 2""",
    "s3_episode_metadata": f"with {META} select episode_index, length from episodes_meta",
    "s5_dataset_catalogue": """select 'tables/lines' as repo_id, count(distinct l_orderkey) as episodes, count(*) as frames from lineitem
union all select 'tables/events', count(distinct user_id), count(*) from events""",
    "a10_vector_dims": """select 'action' as "column", cast(2 as bigint) as min_dim, cast(2 as bigint) as max_dim
union all select 'state', cast(min(case when l_orderkey % 50 = 1 then 3 else 4 end) as bigint),
  cast(max(case when l_orderkey % 50 = 1 then 3 else 4 end) as bigint) from lineitem""",
    "p4_flatten_vectors": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(4 as bigint) as n,
  cast(cast(l_quantity as float) as double) as x0, cast(cast(l_discount as float) as double) as x1,
  cast(cast(l_tax as float) as double) as x2, cast(cast(l_extendedprice as float) as double) as x3,
  cast(l_linenumber as double) as single from lineitem""",
    "j8_frame_count_issues": f"""with {FRAMES} select split, episode_index, camera, expected, decoded from per
where expected > 0 and decoded < expected""",
    "j8_frame_count_issues_strict": f"""with {FRAMES} select split, episode_index, camera, expected, decoded from per
where expected > 0 and decoded <> expected""",
    "j4_attach_frames": f"""with {FRAMES} select s.split, s.camera, s."row", s.episode_idx,
  case when s."row" - p.ep_offset < p.decoded then p.episode_index * 1000 + s."row" - p.ep_offset end as frame
from line_store s join per p on s.split = p.split and s.camera = p.camera and s.episode_idx = p.episode_index""",
    "f6_normalise_values": f"with {PIXELS} select vec_id, copy, array_to_string(b, ',') as bytes from bytes",
    "f6_normalise_pixels": f"""with {PIXELS} select vec_id, copy, cast(1 as bigint) as channels,
  array_to_string(list_transform(b, lambda x: lpad(hex(x), 2, '0')), '') as bytes from bytes""",
    "f6_channel_first": f"""with {PIXELS} select vec_id, copy, pos, cast(case pos % 3 when 0 then v[pos // 3 + 1]
  when 1 then v[64 - pos // 3] else -v[pos // 3 + 1] end as double) as value
from pixel_rows, range(0, 192) t(pos)""",
    "f7_resize_half": f"""with {PIXELS}, small as (
  select vec_id, copy, y * 4 + x as cell,
    (b[16 * y + 2 * x + 1] + b[16 * y + 2 * x + 2] + b[16 * y + 2 * x + 9] + b[16 * y + 2 * x + 10] + 2) // 4 as v
  from bytes, range(0, 4) t(y), range(0, 4) u(x))
select vec_id, copy, string_agg(lpad(hex(v), 2, '0'), '' order by cell) as bytes from small group by 1, 2""",
    "f7_resize_up": f"""with {PIXELS}, centres as (
  select i, greatest(0, least(16 * i - 5, 182)) as place from range(0, 13) t(i)),
axis as (
  select i, place // 26 as low, least(place // 26 + 1, 7) as high, (4096 * (place % 26) + 26) // 52 as w from centres),
cells as (
  select vec_id, copy, y.i * 13 + x.i as cell, y.w,
    (b[8 * y.low + x.low + 1] * (2048 - x.w) + b[8 * y.low + x.high + 1] * x.w) // 16 as above,
    (b[8 * y.high + x.low + 1] * (2048 - x.w) + b[8 * y.high + x.high + 1] * x.w) // 16 as below
  from bytes, axis y, axis x)
select vec_id, copy, cast(13 as bigint) as height, string_agg(lpad(hex(
  (((2048 - w) * above) // 65536 + (w * below) // 65536 + 2) // 4), 2, '0'), '' order by cell) as bytes
from cells group by 1, 2""",
    "u4_decode_texts": f"with {TEXT_FRAMES} select episode_index, frame_pos, decoder, bytes from frames",
    "a7_decoder_counts": f"with {TEXT_FRAMES} select decoder, count(*) as n_files from files where n > 0 group by 1",
    "s4_u4_decode_from_files": f"with {TEXT_FRAMES} select episode_index, frame_pos, decoder, bytes from frames",
    "s8_overwritten_stores": f"""with {LINE_STORE}, {LINE_INDEX}, limits as (
  select max(ep_offset + ep_len) as few from line_index where split = 'val' and ep_pos < 20),
now as (select split, camera, "row" from line_store, limits
  where camera <> {q(CAMERAS[0])} or split = 'train' or (split = 'val' and "row" < few)),
named as (select distinct split, camera from line_store)
select n.split, n.camera, case when n.camera = {q(CAMERAS[0])} and n.split <> 'train' then 'again' else 'tables/lineitem' end as source_repo_id,
  count("row") as n_rows, max("row") as last, true as refused
from named n left join now on now.split = n.split and now.camera = n.camera group by 1, 2, 3""",
    "s9_compressions": f"""with {LINE_STORE} select split, compression, count(*) as n_rows, cast(sum("index") as bigint) as total,
  count(*) * 3 as bytes from line_store, (values ('none'), ('lzf'), ('gzip')) c(compression)
where camera = {q(CAMERAS[0])} group by 1, 2""",
    "v3_v5_v6_faulty_stores": f"""with {ORDER_SPLITS}, {LINE_INDEX}, n as (select split, count(*) as n, max(ep_pos) >= 5 as has from line_index group by 1)
select split, 'mixed' as camera, -1 as ep_pos, 3 as "check", {fmt(K.PIXELS_RANK, "1")} as message from n
union all select split, 'text', -1, 3, {fmt(K.PIXELS_RANK, "1")} from n
union all select split, 'torn', -1, 3, {fmt(K.PIXELS_RANK, "1")} from n
union all select split, 'nested', -1, 5, {q(K.INDEX_RANK)} from n
union all select split, 'fewer', -1, 6, {fmt(K.INDEX_LENGTHS, "n", "(n - 1)")} from n where has""",
    "a3_inspected_faulty_stores": f"""with {LINE_STORE}, {LINE_INDEX}, n as (select split, count(*) as n from step_rows group by 1),
e as (select split, count(*) as eps, count(*) filter (where ep_pos <> 5) as fewer from line_index group by 1),
f as (select unnest(['fewer', 'mixed', 'nested', 'text', 'torn', 'whole']) as camera),
c as (select * from (values ('action', 'float32', ', 2'), ('done', 'bool', ''), ('episode_idx', 'int64', ''), ('index', 'int64', ''),
  ('proprio', 'float32', ', 4'), ('state', 'float32', ', 4'), ('step_idx', 'int64', ''), ('task_index', 'int64', ''),
  ('timestamp', 'float32', '')) t("column", dtype, width))
select split, camera, "column", dtype, n as n_values, '[' || n || width || ']' as shape from n, f, c
union all select split, camera, 'pixels', case camera when 'text' then 'object' else 'uint8' end, n,
  '[' || n || case camera when 'text' then ']' when 'mixed' then ', 1..2, 1, 3]' else ', 1, 1, 3]' end from n, f
union all select split, camera, 'ep_len', 'int64', eps, '[' || eps || ']' from e, f
union all select split, camera, 'ep_offset', case camera when 'nested' then 'object' else 'int64' end,
  case camera when 'fewer' then fewer else eps end, '[' || case camera when 'fewer' then fewer else eps end || ']' from e, f""",
    "v17_replay_checks": f"""with {ORDER_SPLITS} select split, camera,
  case when camera in ('text', 'nested') then 'ValueError' else 'ok' end as outcome
from splits, (select unnest(['fewer', 'mixed', 'nested', 'text', 'torn', 'whole']) as camera)""",
    "v18_requested_positions": f"""with {BAD_STORE}, asked as (
  select o_orderkey, case when o_orderkey % 3 = 0 then 'train' else 'val' end as split, {q(CAMERAS[0])} as camera,
    o_orderkey % 1500 - 4 as ep_pos from orders)
select a.*, ep_offset, ep_len, case when ep_len is null then 'outside' when ep_len <= 0 then 'empty' else 'ok' end as status
from asked a left join bad_index b on b.split = a.split and b.ep_pos = a.ep_pos""",
    "u2_image_rank": f"""with {LINE_STORE} select split, camera, "row", case when "row" % 2 = 0 then 2 else 3 end as rank,
  "row" % 5 + 2 as height, 1 as width, case when "row" % 2 = 0 then 1 else 3 end as channels from line_store""",
    "u3_f10_session_documents": f"""with {ORDER_SPLITS}, {LINE_INDEX}
select 'metadata/session' as entity_path, '{{' || chr(10) || '  "episode_index" : ' || ep_pos || ',' || chr(10) || '  "start_step" : 0,' || chr(10)
  || '  "end_step" : ' || (ep_len - 1) || ',' || chr(10) || '  "split" : "' || split || '"' || chr(10) || '}}' as "text",
  cast(null as double) as "value" from line_index
union all select 'metadata/episode_index', null, cast(ep_pos as double) from line_index
union all select 'metadata/start_step', null, cast(0 as double) from line_index
union all select 'metadata/end_step', null, cast(ep_len - 1 as double) from line_index""",
    "f12_report_time": "select n_nationkey, true as of_form, true as near from nation",
    "p6_p7_name_status": f"""select c_custkey,
  case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'ok'
    else 'Unknown split ' || chr(39) || c_mktsegment || chr(39) || {q(". Available: ['BUILDING', 'MACHINERY'].")} end as split,
  case when n_name in ('FRANCE', 'PERU', 'CHINA') then 'ok'
    else 'Unknown camera ' || chr(39) || n_name || chr(39) || {q(". Available: ['FRANCE', 'PERU', 'CHINA'].")} end as camera
from customer join nation on c_nationkey = n_nationkey""",
    "p12_null_keys": f"""with {EVENT_STEPS}, holes as (
  select "index" as event_id, case when "index" % 11 <> 0 then episode_index end as episode_index,
    case when "index" % 13 <> 1 then frame_index end as frame_index, case when "index" % 17 <> 2 then "index" end as "index"
  from event_steps)
select * from holes where episode_index is null or frame_index is null or "index" is null""",
    "s10_a7_conversion_document": f"""with {CONVERTED}, {issues('conv_steps', split='split')},
{converted("where (split, ep) not in (select (split, episode_index) from issues)")},
kept_counts as (select split, count(*) as kept, sum(ep_len) as n_rows from lens group by 1),
dirty as (select split, count(distinct episode_index) as n from issues group by 1),
used as (select split, case when ep % 3 = 0 then 'any' else 'lower' end as name, count(*) as n_videos from lens group by 1, 2)
select 'tables/conversations' as repo_id, 'ok' as status, 'lower,any' as resolved, 'drop' as dirty_episode_policy, k.split,
  case when coalesce(d.n, 0) > 0 then 'drop_invalid' else 'kept_all' end as action_taken, kept as kept_episode_count, camera,
  cast(n_rows as bigint) as n_rows, true as has_files, o.name, o.n_videos
from kept_counts k join used o on o.split = k.split left join dirty d on d.split = k.split, cameras""",
    "s11_store_document": f"""with {BAD_STORE}, {validate('bad_store', 'bad_index')}, said as ({MESSAGE_ROWS})
select 'validate' as mode, true as of_root, s.split, s.camera, count(m.message) = 0 as valid, count(m.message) as n_errors
from (select distinct split, camera from bad_store) s left join said m on m.split = s.split and m.camera = s.camera
group by s.split, s.camera""",
    "u1_signals_long": f"""with {LINE_STORE}, wide as (
  select *, ep as episode_idx, step0 as step, step0 as step_idx, is_last as done from step_rows)
select split, "row", 'signals/done' as entity_path, step, cast(cast(done as integer) as double) as value from wide
union all select split, "row", 'signals/episode_idx', step, cast(episode_idx as double) from wide
union all select split, "row", 'signals/step_idx', step, cast(step as double) from wide
union all select split, "row", 'signals/action/dim_0', step, cast(quantity as double) from wide
union all select split, "row", 'signals/action/dim_1', step, cast(discount as double) from wide
union all select split, "row", 'signals/state/dim_0', step, cast(quantity as double) from wide
union all select split, "row", 'signals/state/dim_1', step, cast(price as double) from wide
union all select split, "row", 'signals/state/dim_2', step, cast(discount as double) from wide
union all select split, "row", 'signals/state/dim_3', step, cast(tax as double) from wide""",
    "p9_step_window": f"""with {LINE_STORE}, {LINE_INDEX}
select s.split, s.camera, s."row", i.ep_pos, s.step_idx from line_store s join line_index i
  on s.split = i.split and s.episode_idx = i.episode_index
where s."row" - i.ep_offset between 1 and 4 and (s."row" - i.ep_offset - 1) % 2 = 0""",
    "u2_image_stream": f"""with {LINE_STORE} select split, camera, 'episode/pixels' as entity_path, step_idx as step,
  cast(3 as bigint) as rank, lpad(hex("row"), 6, '0') as bytes from line_store""",
    "u3_session_metadata": f"""with {ORDER_SPLITS}, {LINE_INDEX}
select 'metadata/episode_index' as entity_path, count(*) as n, cast(sum(ep_pos) as double) as total from line_index
union all select 'metadata/start_step', count(*), cast(0 as double) from line_index
union all select 'metadata/end_step', count(*), cast(sum(ep_len - 1) as double) from line_index""",
    "f8_source_metadata": """with rows as (
  select *, case when c_custkey % 11 <> 0 then 'val' end as name_split,
    case when c_custkey % 11 <> 0 then 'cam_' || c_nationkey end as name_slug,
    case when c_custkey % 3 = 0 then c_mktsegment end as want_split,
    case when c_custkey % 5 = 0 then 'cam.' || c_nationkey end as want_camera from customer)
select c_custkey, case when c_custkey % 4 <> 0 then 'tables/customer' else 'unknown' end as source_repo_id,
  coalesce(want_split, case when c_custkey % 2 = 0 then 'train' end, name_split, 'unknown') as source_split,
  coalesce(want_camera, case when c_custkey % 7 = 0 then 'observation.images.top' end, name_slug, 'unknown') as source_camera_key
from rows""",
    "f1_f2_f3_f11_f13_names": """with s as (select page_id, url, replace(url, '/', '__') as stem, replace(url, '.', '_') as slug from pages)
select page_id, stem as sanitised, slug, case when instr(stem, '__') > 0 then left(stem, instr(stem, '__') - 1) end as split,
  case when instr(stem, '__') > 0 then substr(stem, instr(stem, '__') + 2) end as rest,
  stem || '__ep' || page_id as export, '/stores/' || stem || '/train__' || slug as path from s""",
    "f4_match_camera": """select c_custkey, case when c_custkey % 2 = 0 then n_name = 'FRANCE' else n_name = 'BRAZIL' end as matches
from customer join nation on c_nationkey = n_nationkey""",
    "f9_to_double": f"""with {LINE_BASE} select ord as "index", cast(cast(is_last as integer) as double) as done,
  cast(step0 as double) as frame_index, cast(cast(step0 / 10 as float) as double) as "timestamp" from line_base""",
    "e1_convert_drop": f"""with {CONVERTED}, {issues('conv_steps', split='split')},
{converted("where (split, ep) not in (select (split, episode_index) from issues)")}
select p.split, camera, p."row", p.ep as episode_idx, p.frame_index as step_idx, p.done, p."index", p.ep % 3 as task_index,
  cast(p.size as double) as state_0, rpad('turn ' || (p."row" - i.ep_offset) || ' of ' || i.ep, 64, '.') as frame
from placed p join conv_index i on p.split = i.split and p."row" >= i.ep_offset and p."row" < i.ep_offset + i.ep_len, cameras""",
    "s10_conversion_report": f"""with {CONVERTED}, {issues('conv_steps', split='split')},
asked as (select distinct split, ep from steps join splits on ep >= lo and ep < hi)
select a.split, a.ep as episode_index, m.issues is null as valid, m.issues is null as kept, coalesce(m.issues, '') as issues
from asked a left join (select split, episode_index, string_agg(message, '; ' order by run_start, seq) as issues
  from issues group by 1, 2) m on m.split = a.split and m.episode_index = a.ep""",
    "s11_store_report": f"with {BAD_STORE}, {validate('bad_store', 'bad_index')} {MESSAGE_ROWS}",
    "e3_replay": f"""with {LINE_STORE}, {LINE_INDEX}, shown as (
  select s.* from line_store s join line_index i
    on s.split = i.split and s."row" >= i.ep_offset and s."row" < i.ep_offset + i.ep_len
  where s.split = 'val' and s.camera = {q(CAMERAS[1])} and i.ep_pos = 7 and (s."row" - i.ep_offset) % 2 = 0)
select entity_path, step_idx as step, value from (
  select *, unnest(['done', 'episode_idx', 'step_idx', 'action/dim_0', 'action/dim_1', 'state/dim_0', 'state/dim_1',
      'state/dim_2', 'state/dim_3']) as name,
    unnest([cast(cast(done as integer) as double), episode_idx, step_idx, quantity, discount, quantity, price, discount, tax]) as value,
    'signals/' || name as entity_path
  from shown)""",
    "e2_convert_warn_validate": f"""with {CONVERTED}, {converted("")}, conv_store as (
  select split, camera, "row", ep as episode_idx, frame_index as step_idx, done, false as no_action, 1 as channels
  from placed, cameras), {validate('conv_store', 'conv_index')} {MESSAGE_ROWS}""",
}
