"""SQL for another engine that gives the queries' rows."""

from __future__ import annotations

from ..config import CLASSES
from . import fixture as X

DET = f"det as ({X.DETECTIONS.format(lineitem='lineitem')})"
LAY = f"lay as ({X.LAYOUT.format(detections='select * from det')})"
DIM = "dim as (select * from (values " + ", ".join(f"({i}, '{n}', '{c}', '{t}', {p})" for i, n, c, t, p in CLASSES) + ") v(class, name, color, type, priority))"
PX = f"""px as (select cast(floor(s/12) as bigint) as tile_no, s%12+1 as z, y, x, (s*977+y*y*31+x*x*17+x*y*13)%4001 as c1, (s*577+y*y*19+x*x*29+x*y*7)%3001 as c2
  from (select cast(s_suppkey as bigint) as s from supplier) a cross join (select unnest(range({X.EDGE})) as y) b cross join (select unnest(range({X.EDGE})) as x) c)"""
BOX = "box as (select * replace (x1*0.078125e0 as x1, y1*0.078125e0 as y1, x2*0.078125e0 as x2, y2*0.078125e0 as y2) from det)"
SEAM = " or ".join(f"(floor(({c}+32)/192)>=1 and floor(({c}+32)/192)*192<512 and (cast({c} as bigint)+32)%192<128)" for c in ("x1", "y1"))
EXT = f"ext as (select min(abs_x) as x_min, min(abs_y) as y_min, max(abs_x)-min(abs_x)+{X.TILE} as width, max(abs_y)-min(abs_y)+{X.TILE} as height, {X.SLICES}-max(abs_z)+min(abs_z) as depth, max(abs_z) as z_start from lay)"
PLACED = f"""{DET}, {LAY}, {EXT}, placed as (select det_id, d.tile_no, z-(z_start-abs_z) as z, class, score, mean, x1+abs_x-x_min as x1, y1+abs_y-y_min as y1, x2+abs_x-x_min as x2, y2+abs_y-y_min as y2,
    row, col, abs_x-x_min as ax, abs_y-y_min as ay from det d join lay l on d.tile_no=l.tile_no cross join ext where z-1>=z_start-abs_z and z-1<z_start-abs_z+depth)"""
OWNED = f"""{PLACED}, own as (select * from placed p where not exists (select 1 from lay n cross join ext where ((n.row=p.row and n.col=p.col-1) or (n.row=p.row-1 and n.col=p.col))
    and floor((p.x1+p.x2)/2)>=greatest(p.ax,n.abs_x-x_min) and floor((p.x1+p.x2)/2)<least(p.ax,n.abs_x-x_min)+{X.TILE}
    and floor((p.y1+p.y2)/2)>=greatest(p.ay,n.abs_y-y_min) and floor((p.y1+p.y2)/2)<least(p.ay,n.abs_y-y_min)+{X.TILE}))"""


def greedy(before: str, rows: str, keys: str, order: str, hit: str) -> str:
    """CTEs that end in kept(det_id): the rows that no earlier kept row hits. hit speaks of k, kept, and s, current."""
    same = " and ".join(f"s.{k}=g.{k}" for k in keys.split(","))
    box = "{'x1': s.x1, 'y1': s.y1, 'x2': s.x2, 'y2': s.y2}"
    found = f"len(list_filter(g.kept, lambda k: {hit}))>0"
    sk = ", ".join(f"s.{k}" for k in keys.split(","))
    return f"""recursive {before}, s as (select *, row_number() over (partition by {keys} order by {order}) as rn from ({rows}) q),
      g as (select {sk}, s.rn, s.det_id, true as ok, [{box}] as kept from s where s.rn=1
        union all select {sk}, s.rn, s.det_id, not ({found}), case when {found} then g.kept else list_append(g.kept, {box}) end from g join s on {same} and s.rn=g.rn+1),
      kept as (select det_id from g where ok)"""


def inter(a: str, b: str, plus: int) -> str:
    return f"(greatest(0e0, least({a}.x2,{b}.x2)-greatest({a}.x1,{b}.x1)+{plus})*greatest(0e0, least({a}.y2,{b}.y2)-greatest({a}.y1,{b}.y1)+{plus}))"


def area(a: str, plus: int) -> str:
    return f"(({a}.x2-{a}.x1+{plus})*({a}.y2-{a}.y1+{plus}))"


I0, AK, AS = inter("k", "s", 0), area("k", 0), area("s", 0)
PRIORITY = greedy(f"{DET}, {DIM}", "select det.*, priority from det join dim on det.class=dim.class", "tile_no,z", "priority desc, score desc, class, det_id", f"{I0}>0 and ({I0}/({AK}+{AS}-{I0})>0.35e0 or {I0}/{AS}>0.70e0 or {I0}/{AK}>0.70e0)")
SEAMS = greedy(f"{DET}, flagged as (select *, {SEAM} as on_seam from det)", "select * from flagged where on_seam", "tile_no,z,class", "score desc, det_id", f"{inter('k', 's', 1)}/{area('s', 1)}>0.5e0")
MAXIMA = "maxima as (select tile_no, z, y, x, c1 from (select *, max(mx) over (partition by tile_no, z, x order by y range between 2 preceding and 2 following) as m from (select *, max(c1) over (partition by tile_no, z, y order by x range between 2 preceding and 2 following) as mx from px) a) b where c1=m)"
SPOTS = f"{PX}, {MAXIMA}, lev as (select tile_no, z, greatest(quantile_cont(c1, 0.98e0), 100e0) as level from px group by all), spots as (select m.* from maxima m join lev l on m.tile_no=l.tile_no and m.z=l.z where c1>level)"
HITS = f"{DET}, {BOX}, {SPOTS}, hits as (select * from spots p where exists (select 1 from box b where b.tile_no=p.tile_no and b.z=p.z and p.x>=b.x1 and p.x<=b.x2 and p.y>=b.y1 and p.y<=b.y2))"
CUT = "select det_id, tile_no, z, class, " + ", ".join(f"least(greatest(cast(trunc({c}) as bigint), 0), {X.EDGE}) as {c}" for c in ("x1", "y1", "x2", "y2"))
CONF = "count(*) as detection_count, avg(score) as avg_conf, median(score) as median_conf, avg(case when score<0.6e0 then 1e0 else 0e0 end) as low_conf_ratio"
WINDOWS = "win as (select tile_no, z, wx, wy, least(wx+16, 40) as x_end, least(wy+16, 40) as y_end from (select distinct tile_no, z from px) i cross join (select unnest([0,12,24,36]) as wx) a cross join (select unnest([0,12,24,36]) as wy) b)"
STRETCHED = "lim as (select tile_no, z, " + ", ".join(f"quantile_cont({c}, 0.1e0/100) as lo{c}, quantile_cont({c}, 99.9e0/100) as hi{c}, max({c}) as most{c}" for c in ("c1", "c2")) + " from px where y%10=0 and x%10=0 group by all), st as (select p.tile_no, p.z, y, x, " + ", ".join(f"case when most{c}=0 or hi{c}<=lo{c} then 0 else cast(floor((least(greatest(cast({c} as double), lo{c}), hi{c})-lo{c})/(hi{c}-lo{c})*255e0) as integer) end as s{c[1]}" for c in ("c1", "c2")) + " from px p join lim l on p.tile_no=l.tile_no and p.z=l.z)"
LAPLACE = "select tile_no, z, round(var_pop(coalesce(u,d)+coalesce(d,u)+coalesce(l,r)+coalesce(r,l)-4*c1), 3) as sharpness from (select *, lag(c1) over v as u, lead(c1) over v as d, lag(c1) over h as l, lead(c1) over h as r from px window v as (partition by tile_no, z, x order by y), h as (partition by tile_no, z, y order by x)) q group by all"
NAMES = "concat('r', lpad(cast((tile_no*7)%5 as varchar), 5, '0'), '_c', lpad(cast((tile_no*3)%8 as varchar), 5, '0'))"
GA = inter("a", "b", 0)
LINK = f"greatest({GA}/({area('a', 0)}+{area('b', 0)}-{GA}+1e-6), {GA}/({area('a', 0)}+1e-6), {GA}/({area('b', 0)}+1e-6))>0.4e0"
LOGIC = f"""{DET}, {BOX}, {PX}, draw as (select * from (select *, row_number() over (partition by tile_no, z order by (det_id*7919+42*104729)%1000003, det_id) as r from box) q where r<=50),
  cut as ({CUT} from draw), sums as (select c.det_id, c.tile_no, c.z, c.class, coalesce(avg(p.c1), 0e0) as m1, coalesce(avg(p.c2), 0e0) as m2 from cut c left join px p on p.tile_no=c.tile_no and p.z=c.z and p.x>=c.x1 and p.x<c.x2 and p.y>=c.y1 and p.y<c.y2 group by all),
  img as (select tile_no, z, avg(c1) as mean1, avg(c2) as mean2 from px group by all),
  snr as (select s.tile_no, s.z, class%3 as color, m1/(mean1+1e-6) as s1, m2/(mean2+1e-6) as s2 from sums s join img i on s.tile_no=i.tile_no and s.z=i.z),
  ok as (select *, case color when 0 then s1>1.2e0 when 1 then s2>1.2e0 else s1>1.2e0 and s2>1.2e0 end as ok from snr)"""
SIDES = [("x1", "y1", "x2", "y1"), ("x2", "y1", "x2", "y2"), ("x2", "y2", "x1", "y2"), ("x1", "y2", "x1", "y1")]
SIDE_ROWS = " union all ".join(f"select det_id, class, {i} as side, cast({a} as bigint) as ax, cast({b} as bigint) as ay, cast({c} as bigint) as bx, cast({d} as bigint) as y_b from det" for i, (a, b, c, d) in enumerate(SIDES))


def part(a: str, b: str, k: str) -> str:
    return f"cast(trunc({a}+({b}-{a})*cast({k} as double)/n) as bigint)"


def oracle_sql() -> dict[str, str]:
    summary = "union all ".join(f"select '{g}' as grp, {c} as category, count(k.det_id) as n from dim left join (select det.class, det.det_id from det join kept on det.det_id=kept.det_id) k on k.class=dim.class group by {c} " for g, c in (("Class", "name"), ("Color", "color"), ("Type", "type")))
    return {
        "seam_flag": f"with {DET} select det_id, {SEAM} as on_seam from det",
        "seam_suppress": f"with {SEAMS} select det_id, tile_no, z, class, score from flagged where not on_seam or det_id in (select det_id from kept)",
        "priority_suppress": f"with {PRIORITY} select det_id, tile_no, z, class, score from det where det_id in (select det_id from kept)",
        "layout_extents": f"with {DET}, {LAY}, {EXT} select * from ext",
        "globalise_zclip": f"with {PLACED} select det_id, tile_no, z, x1, y1, x2, y2 from placed",
        "ownership_dedup": f"with {OWNED} select det_id, tile_no, z, x1, y1, x2, y2 from own",
        "centroids": f"with {DET} select det_id, z, (x1+x2)/2 as cx, (y1+y2)/2 as cy, score, class, mean from det",
        "class_summary": f'with {PRIORITY}, c as ({summary}) select grp as "group", category, n as count, round(n*100e0/(select count(*) from kept)+1e-9,6) as percentage from c',
        "per_class_sorted": f"with {DET}, {DIM} select name as class_name, (x1+x2)/2 as cx, (y1+y2)/2 as cy, z, score, tile_no, det_id from det join dim on det.class=dim.class",
        "grid_index_from_names": f"with {DET}, {LAY}, nm as (select {NAMES} as name, min(tile_no) as pos from lay group by 1), rk as (select left(name,6) as k, row_number() over (order by min(pos))-1 as i from nm group by 1), ck as (select right(name,6) as k, row_number() over (order by min(pos))-1 as i from nm group by 1) select name, rk.i as grid_row, ck.i as grid_col from nm join rk on left(name,6)=rk.k join ck on right(name,6)=ck.k",
        "channel_pairing_left": f"with {DET}, b as (select tile_no, z, count(*) as n from det where score>=0.95e0 group by all) select a.tile_no as tile_name, a.z as stem, coalesce(b.n,0) as content_2 from (select distinct tile_no, z from det) a left join b on a.tile_no=b.tile_no and a.z=b.z",
        "resume_anti": f"with {DET} select distinct tile_no, z from det except select tile_no, z from det where score>=0.97e0",
        "tile_range": f"with {DET}, {LAY} select tile_no from (select tile_no, row_number() over (order by lpad(cast(tile_no as varchar), 8, '0')) as n from lay) q where n between 2 and 5",
        "sampled_frames": f"with {DET} select det_id, z from det where (z-1)%5<2",
        "nearest_source": f"with {OWNED}, c as (select det_id, z, (x1+x2)/2 as cx, (y1+y2)/2 as cy from placed), m as (select det_id, z, (x1+x2)/2 as cx, (y1+y2)/2 as cy from own), j as (select m.det_id as l, c.det_id as r, (m.cx-c.cx)*(m.cx-c.cx)+(m.cy-c.cy)*(m.cy-c.cy) as d2 from m join c on m.z=c.z and c.cx>=m.cx-8 and c.cx<=m.cx+8 and c.cy>=m.cy-8 and c.cy<=m.cy+8) select l as left_id, r as right_id, d2 from (select *, row_number() over (partition by l order by d2, r) as n from j where d2<=64) q where n=1",
        "local_maxima": f"with {PX}, {MAXIMA} select * from maxima",
        "peaks_in_boxes_semi": f"with {HITS} select * from hits",
        "miss_ratio": f"with {HITS}, img as (select distinct tile_no, z from px), al as (select tile_no, z from spots union select b.tile_no, b.z from box b join img i on b.tile_no=i.tile_no and b.z=i.z), sn as (select tile_no, z, count(*) as n from spots group by all), hn as (select tile_no, z, count(*) as n from hits group by all) select al.tile_no, al.z, coalesce(sn.n,0) as spots, coalesce(hn.n,0) as hits, round(case when coalesce(sn.n,0)=0 then 0e0 else 1-coalesce(hn.n,0)*1e0/sn.n end+1e-9,6) as miss_ratio from al left join sn on al.tile_no=sn.tile_no and al.z=sn.z left join hn on al.tile_no=hn.tile_no and al.z=hn.z",
        "conf_stats": f"with {DET} select tile_no, z, detection_count, round(avg_conf+1e-9,6) as avg_conf, round(median_conf+1e-9,6) as median_conf, round(low_conf_ratio+1e-9,6) as low_conf_ratio from (select tile_no, z, {CONF} from det group by all) q",
        "percentile_stretch": f"with {PX}, lim as (select tile_no, z, quantile_cont(c1, 0.1e0/100) as lo, quantile_cont(c1, 99.9e0/100) as hi, max(c1) as most from px where y%10=0 and x%10=0 group by all) select p.tile_no, p.z, y, x, case when most=0 or hi<=lo then 0 else cast(floor((least(greatest(cast(c1 as double), lo), hi)-lo)/(hi-lo)*255e0) as integer) end as stretched from px p join lim l on p.tile_no=l.tile_no and p.z=l.z",
        "sliding_windows": f"with {PX}, {WINDOWS} select * from win",
        "blank_windows": f"with {PX}, {WINDOWS} select w.tile_no, w.z, wx, wy from win w where exists (select 1 from px p where p.tile_no=w.tile_no and p.z=w.z and c1>=3950 and x>=wx and x<x_end and y>=wy and y<y_end)",
        "laplacian_var": f"with {PX} {LAPLACE}",
        "saturation": f"with {PX} select tile_no, z, round(avg(case when c1>3900 then 1e0 else 0e0 end)+1e-9,6) as saturation_ratio, round(avg(c1)+1e-9,6) as mean_intensity from px group by all",
        "resize_nearest": f"with {PX} select tile_no, z, cast(y/2 as bigint) as y, cast(x/2 as bigint) as x, c1 from px where y%2=0 and x%2=0",
        "channel_compose": f"with {PX} select tile_no, z, y, x, c1, case when c2>500 then c2 else 0 end as c2 from px",
        "box_mean": f"with {DET}, {BOX}, {PX}, cut as ({CUT} from box) select c.det_id, round(coalesce(sum(p.c1+p.c2)*1e0/(3*count(p.c1)), 0e0)+1e-9,6) as mean from cut c left join px p on p.tile_no=c.tile_no and p.z=c.z and p.x>=c.x1 and p.x<c.x2 and p.y>=c.y1 and p.y<c.y2 group by c.det_id",
        "channel_logic": f"with {LOGIC} select tile_no, z, count(*) as checks, round(avg(case when ok then 0e0 else 1e0 end)+1e-9,6) as logic_mismatch_rate, round(coalesce(avg(case when color=2 and ok then s1/(s2+1e-6) end), 0e0)+1e-9,6) as yellow_balance from ok group by all",
        "tile_qc_rollup": f"with {LOGIC}, c as (select tile_no, z, {CONF} from det group by all), sh as ({LAPLACE.replace('round(', '(').replace(', 3) as', ') as')}), lg as (select tile_no, z, round(avg(case when ok then 0e0 else 1e0 end)+1e-9,6) as e from ok group by all), t as (select c.tile_no, cast(sum(detection_count) as bigint) as total_cells, avg(avg_conf) as a, avg(sharpness) as b, avg(e) as e, count(*) as total_layers from c join sh on c.tile_no=sh.tile_no and c.z=sh.z join lg on c.tile_no=lg.tile_no and c.z=lg.z group by c.tile_no) select tile_no, total_cells, round(a+1e-9,6) as avg_confidence, round(b,3) as avg_sharpness, round(1e-9,6) as max_drift, round(e+1e-9,6) as avg_logic_error, total_layers, case when e>0.15e0 then 'FAIL' else 'PASS' end as qc_status from t",
        "slice_metrics": f"with {DET}, {BOX}, {PX}, " + ", ".join(f"q{c} as (select * replace ({c} as c1) from px), m{c} as ({MAXIMA.split(' as (', 1)[1][:-1].replace('from px', f'from q{c}')}), l{c} as (select tile_no, z, greatest(quantile_cont(c1, 0.98e0), 100e0) as level, round(avg(c1)+1e-9,6) as mean_intensity from q{c} group by all), s{c} as ({LAPLACE.replace('from px', f'from q{c}')}), n{c} as (select l.tile_no, l.z, l.mean_intensity, round(count(m.c1)+1e-9,6) as spots, sharpness from l{c} l join s{c} s on l.tile_no=s.tile_no and l.z=s.z left join m{c} m on m.tile_no=l.tile_no and m.z=l.z and m.c1>level group by all)" for c in ("c1", "c2")) + ", d as (select tile_no, z, count(*) as n from box group by all) select a.tile_no, a.z, coalesce(d.n, 0) as detection_count, a.mean_intensity as c1_mean_intensity, a.spots as c1_cv_bright_spots, a.sharpness as c1_sharpness, b.mean_intensity as c2_mean_intensity, b.spots as c2_cv_bright_spots, b.sharpness as c2_sharpness from nc1 a join nc2 b on a.tile_no=b.tile_no and a.z=b.z left join d on a.tile_no=d.tile_no and a.z=d.z",
        "measured_means": f"with {DET}, {BOX}, {PX}, cut as ({CUT} from box) select c.det_id, round(coalesce(sum(p.c1+p.c2)*1e0/(3*count(p.c1)), 0e0)+1e-9,6) as mean from cut c join (select distinct tile_no, z from px) i on i.tile_no=c.tile_no and i.z=c.z left join px p on p.tile_no=c.tile_no and p.z=c.z and p.x>=c.x1 and p.x<c.x2 and p.y>=c.y1 and p.y<c.y2 group by c.det_id",
        "detect_windows": f"with {PX}, {WINDOWS}, {STRETCHED}, blocks as (select w.tile_no, w.z, wx, wy, (x-wx)//4 as bx, (y-wy)//4 as b_y, sum(s1+s2)/48e0 as m from win w join st p on p.tile_no=w.tile_no and p.z=w.z and x>=wx and x<x_end and y>=wy and y<y_end group by all having count(*)=16) select b.tile_no, b.z, cast(wx+4*bx as double) as x1, cast(wy+4*b_y as double) as y1, cast(wx+4*bx+4 as double) as x2, cast(wy+4*b_y+4 as double) as y2, round(m/255+1e-9,6) as score, cast(0 as bigint) as class from blocks b where m>90 and m/255>=0.36e0",
        "sinks_and_readers": f"with {DET}, {DIM} select z, name as class_name, count(*) as boxes, round(sum(x1)+sum(y2)*3, 3) as places, round(sum(score)+1e-9,6) as scores from det join dim on det.class=dim.class group by all",
        "z_downsample": f"with {DET} select det_id, tile_no, cast(floor((z-1)/2) as bigint)+1 as z from det where (z-1)%2=0",
        "dashed_segments": f"with {DET}, sd as ({SIDE_ROWS}), n as (select *, case when class<3 then greatest(1, cast(floor((abs(bx-ax)+abs(y_b-ay))/8) as bigint)) else 1 end as n from sd), k as (select *, unnest(range(0, n, 2)) as k from n) select det_id, side, k, {part('ax', 'bx', 'k')} as sx, {part('ay', 'y_b', 'k')} as sy, {part('ax', 'bx', '(k+1)')} as ex, {part('ay', 'y_b', '(k+1)')} as ey from k",
        "link_candidates": f"with {OWNED}, o as (select * from own) select a.det_id as a, b.det_id as b from o a join o b on a.class=b.class and b.z>a.z and b.z<=a.z+3 and a.x1<b.x2 and b.x1<a.x2 and a.y1<b.y2 and b.y1<a.y2 where {LINK}",
    }
