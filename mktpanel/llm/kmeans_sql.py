"""DuckDB SQL for the clustering query: its rounds written out one after another."""

from __future__ import annotations


def _assigned(r: int) -> str:
    """Nearest centroid of every vector by squared distance, ties to the smaller number."""
    return f"""
a{r} as materialized (
  select rid, arg_min(c, (d, c))::int as cluster, min(d) as d
  from (select rid, c, list_sum(list_transform(list_zip(v.e, m.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from v, c{r} m)
  group by rid)"""


def _moved(r: int) -> str:
    """Floors of the means; an empty cluster keeps its centroid."""
    return f"""
s{r} as (
  select cluster, i, sum(x)::bigint as s, count(*)::bigint as n
  from (select cluster, unnest(v.e) as x, generate_subscripts(v.e, 1) as i from a{r} join v using (rid))
  group by cluster, i),
m{r} as (select cluster, list((s - ((s % n) + n) % n) // n order by i) as e from s{r} group by cluster),
c{r + 1} as materialized (
  select c, coalesce(m{r}.e, c{r}.e) as e from c{r} left join m{r} on m{r}.cluster = c{r}.c)"""


def sql(k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, seed: int = 3) -> str:
    head = f"""
with v as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as e
  from embeddings
  where vec_id is not null and len(embedding) = {dims}
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
c0 as materialized (
  select (row_number() over (order by sha256('{seed}:' || vec_id), e) - 1)::int as c, e
  from v order by sha256('{seed}:' || vec_id), e limit {k})"""
    steps = [head] + [part for r in range(rounds) for part in (_assigned(r), _moved(r))] + [_assigned(rounds)]
    return ",".join(steps) + f"""
select v.vec_id, a.cluster, a.d as distance, sum(a.d) over (partition by a.cluster)::bigint as cluster_inertia,
       sum(a.d) over ()::bigint as inertia, sha256(array_to_string(m.e, ',')) as centroid_sha256
from a{rounds} a join v using (rid) join c{rounds} m on m.c = a.cluster
"""
