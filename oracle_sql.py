"""DuckDB SQL twins of the registered queries (the correctness oracle).

The oracle is written independently of the Spark code: unify uses window
functions with IGNORE NULLS and QUALIFY (the form of the reference's SQL),
merge is a full outer join with CASE/coalesce, and multi-batch runs use a
closed form of "apply the batches in order". Feed definitions and column rules are stated
here a second time, not imported.
"""

from __future__ import annotations

from dataclasses import dataclass, field

MARK = "-11111"

# The rules that the queries' policies are checked against, stated here once more.
NEWEST, OLDEST, ROW, INSERT_ONLY, NOT_MERGED = "newest", "oldest", "row", "insert only", "not merged"
WIDE_COLUMNS, LOADED_COLUMNS = 190, 189


@dataclass
class Rules:
    unify_rules: dict[str, str]
    merge_rules: dict[str, str] = field(default_factory=dict)
    keys: tuple[str, ...] = ("uid", "utype")
    order_by: str = "createddate"
    tie_break: tuple[str, ...] = ("epoch",)
    nulls_first: bool = True

    def unified_columns(self) -> list[str]:
        return [*self.keys, *self.unify_rules]

    def merge_rule(self, col: str) -> str:
        return self.merge_rules.get(col, "patch")

    def profile_columns(self) -> list[str]:
        return [c for c in self.unified_columns() if self.merge_rule(c) != NOT_MERGED]


FEED_POLICY = Rules({"cid": ROW, "att1": NEWEST, "att2": NEWEST, "att3": NEWEST, "ad": OLDEST, "createddate": ROW}, {"ad": INSERT_ONLY, "createddate": NOT_MERGED})


def wide_policy() -> Rules:
    return Rules({"cid": ROW, **{f"att{j}": NEWEST for j in range(WIDE_COLUMNS)}, "createddate": ROW}, {"createddate": NOT_MERGED})


def wide_load_policy() -> Rules:
    """All but the last two of the loaded attributes keep their newest value; those two their oldest, and are never updated."""
    last = (f"att{LOADED_COLUMNS - 2}", f"att{LOADED_COLUMNS - 1}")
    rules = {f"att{j}": NEWEST for j in range(LOADED_COLUMNS)} | dict.fromkeys(last, OLDEST)
    return Rules({"cid": ROW, **rules, "createddate": ROW}, dict.fromkeys(last, INSERT_ONLY))


# ---------------------------------------------------------------- feeds -----

def _utype(marker_key: bool = False) -> str:
    base = "CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'app' END"
    if marker_key:
        return f"CASE WHEN event_type = 'error' THEN '{MARK}' ELSE {base} END"
    return base


def profile_feed_sql(marker_key: bool = False, skewed: bool = False) -> str:
    uid = "CASE WHEN event_id % 3 = 0 THEN CAST(0 AS BIGINT) ELSE user_id END" if skewed else "user_id"
    return f"""
SELECT {uid} AS uid,
       {_utype(marker_key)} AS utype,
       event_id AS epoch,
       ts AS createddate,
       ts + to_seconds((event_id % 17) * 97) AS epoch_ts,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'c' || CAST(event_id AS VARCHAR) END AS cid,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '{MARK}' ELSE event_type END AS att1,
       CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 11 = 0 THEN CAST({MARK} AS DOUBLE) ELSE value END AS att2,
       CASE WHEN event_id % 2 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST({MARK} AS BIGINT) ELSE event_id % 1000 END AS att3,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS ad
FROM events"""


def orders_feed_sql() -> str:
    return f"""
SELECT o_custkey AS uid,
       o_orderstatus AS utype,
       o_orderkey AS epoch,
       o_orderdate AS createddate,
       o_orderdate + to_seconds((o_orderkey % 23) * 3601) AS epoch_ts,
       'o' || CAST(o_orderkey AS VARCHAR) AS cid,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS att1,
       CASE WHEN o_orderkey % 9 = 0 THEN CAST({MARK} AS DOUBLE) ELSE o_totalprice END AS att2,
       CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey END AS att3,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS ad
FROM orders"""


def wide_feed_sql(n: int = WIDE_COLUMNS) -> str:
    atts = ",\n       ".join(
        f"CASE WHEN (event_id + {j}) % 3 = 0 THEN NULL "
        f"ELSE event_type || '_' || CAST(event_id % {j % 7 + 7} AS VARCHAR) END AS att{j}"
        for j in range(n))
    return f"""
SELECT user_id AS uid,
       {_utype()} AS utype,
       event_id AS epoch,
       ts AS createddate,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'c' || CAST(event_id AS VARCHAR) END AS cid,
       {atts}
FROM events"""


def wide_load_sql() -> str:
    def att(j: int) -> str:
        plain = f"CASE WHEN (event_id + {j}) % 3 = 0 THEN NULL ELSE event_type || '_' || CAST(event_id % {j % 7 + 7} AS VARCHAR) END"
        return f"CASE WHEN event_id % 29 = 0 THEN '{MARK}' ELSE {plain} END AS att{j}" if j % 10 == 0 else f"{plain} AS att{j}"
    atts = ", ".join(att(j) for j in range(189))
    extra = ", ".join(f"CAST(event_id % {j + 3} AS VARCHAR) AS extra{j}" for j in range(16))
    return f"""
SELECT user_id AS uid, {_utype()} AS utype, ts AS createddate,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'c' || CAST(event_id AS VARCHAR) END AS cid,
       {atts}, {extra}, event_id AS epoch
FROM events"""


def narrow_feed_sql() -> str:
    return f"""
SELECT user_id AS uid, {_utype()} AS utype, event_id AS epoch, ts AS createddate, CAST(event_id % 100 AS BIGINT) AS tiny,
       CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 50) / 4.0 END AS DECIMAL(4, 2)) AS dec
FROM events"""


# ---------------------------------------------------------------- unify -----

def _order(policy: Rules, reverse: bool = False) -> str:
    """ORDER BY text of the event order, newest first (or oldest first)."""
    if not reverse:
        nulls = "NULLS FIRST" if policy.nulls_first else "NULLS LAST"
        parts = [f"{policy.order_by} DESC {nulls}"] + [f"{t} DESC NULLS LAST" for t in policy.tie_break]
    else:
        nulls = "NULLS LAST" if policy.nulls_first else "NULLS FIRST"
        parts = [f"{policy.order_by} ASC {nulls}"] + [f"{t} ASC NULLS FIRST" for t in policy.tie_break]
    return ", ".join(parts)


def unify_sql(src: str, policy: Rules) -> str:
    """Window form with a full frame and a top-1 filter, as the reference writes it."""
    keys = ", ".join(policy.keys)
    w = f"PARTITION BY {keys} ORDER BY {_order(policy)}"
    full = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    sel = []
    for c in policy.unified_columns():
        rule = policy.unify_rules.get(c)
        if rule == NEWEST:
            sel.append(f"first_value({c} IGNORE NULLS) OVER {full} AS {c}")
        elif rule == OLDEST:
            sel.append(f"last_value({c} IGNORE NULLS) OVER {full} AS {c}")
        else:
            sel.append(c)
    return (f"SELECT {', '.join(sel)} FROM {src} "
            f"QUALIFY row_number() OVER ({w}) = 1")


def top1_sql(src: str, policy: Rules, cols: list[str]) -> str:
    keys = ", ".join(policy.keys)
    return (f"SELECT {', '.join(cols)} FROM {src} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {_order(policy)}) = 1")


# ---------------------------------------------------------------- merge -----

_TYPES = {"cid": "str", "att1": "str", "att2": "num", "att3": "num", "ad": "other",
          "uid": "num", "utype": "str", "createddate": "other"}


def _is_marker(expr: str, kind: str) -> str:
    if kind == "str":
        return f"coalesce({expr} = '{MARK}', false)"
    if kind == "num":
        return f"coalesce({expr} = {MARK}, false)"
    return "false"


def merge_sql(target: str, batch: str, policy: Rules, types: dict[str, str] | None = None,
              clear_on_insert: bool = False, null_marker_keys: bool = False,
              with_state: bool = False) -> str:
    types = types or _TYPES
    keys = list(policy.keys)
    cols = policy.profile_columns()
    on = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    matched = "t.__t IS NOT NULL AND u.__u IS NOT NULL"
    sel = []
    for k in keys:
        if null_marker_keys:
            sel.append(f"CASE WHEN {matched} AND {_is_marker('t.' + k, types.get(k, 'str'))} THEN NULL "
                       f"ELSE coalesce(t.{k}, u.{k}) END AS {k}")
        else:
            sel.append(f"coalesce(t.{k}, u.{k}) AS {k}")
    for c in cols:
        if c in keys:
            continue
        kind = types.get(c, "str")
        ins = f"u.{c}"
        if clear_on_insert:
            ins = f"CASE WHEN {_is_marker('u.' + c, kind)} THEN NULL ELSE u.{c} END"
        if policy.merge_rule(c) == INSERT_ONLY:
            upd = f"t.{c}"
        else:
            upd = f"CASE WHEN {_is_marker('u.' + c, kind)} THEN NULL ELSE coalesce(u.{c}, t.{c}) END"
        sel.append(f"CASE WHEN t.__t IS NULL THEN {ins} WHEN {matched} THEN {upd} ELSE t.{c} END AS {c}")
    if with_state:
        sel.append(f"CASE WHEN t.__t IS NULL THEN 'inserted' WHEN {matched} THEN 'updated' "
                   f"ELSE 'untouched' END AS __state")
    tcols = ", ".join(cols)
    return (f"SELECT {', '.join(sel)} FROM (SELECT {tcols}, true AS __t FROM {target}) t "
            f"FULL OUTER JOIN (SELECT {tcols}, true AS __u FROM {batch}) u ON {on}")


# ------------------------------------------------------- two-slice runs -----

def two_slices(feed_sql: str, policy: Rules = FEED_POLICY) -> str:
    """CTEs: feed, hw (high-water mark and midpoint), s1 = (-1, mid], s2 = (mid, hi],
    u1/u2 = unified slices."""
    return f"""
feed AS ({feed_sql}),
hw AS (SELECT max(epoch) AS hi, max(epoch) // 2 AS mid FROM feed),
s1 AS (SELECT * FROM feed WHERE epoch > -1 AND epoch <= (SELECT mid FROM hw)),
s2 AS (SELECT * FROM feed WHERE epoch > (SELECT mid FROM hw) AND epoch <= (SELECT hi FROM hw)),
u1 AS ({unify_sql('s1', policy)}),
u2 AS ({unify_sql('s2', policy)})"""


def profile_cols(policy: Rules = FEED_POLICY) -> str:
    return ", ".join(policy.profile_columns())


def flagship_sql() -> str:
    return f"""WITH {two_slices(profile_feed_sql())},
m AS ({merge_sql('u1', 'u2', FEED_POLICY)})
SELECT {profile_cols()} FROM m"""


# --------------------------------------------------- multi-batch replay -----

def replay_sql(src: str, policy: Rules, batch_expr: str, types: dict[str, str] | None = None) -> str:
    """Profile after applying every batch of ``src`` in batch order, in closed form.

    For a patch column the last batch holding a non-null value decides: its
    newest non-null value, cleared to NULL when it is the marker, unless that
    batch is the key's first (insert keeps the marker). Row columns use the
    batch's top row instead of the newest non-null value. Insert-only columns
    keep the value of the key's first batch.
    """
    types = types or _TYPES
    keys = ", ".join(policy.keys)
    order = _order(policy)
    cols = [c for c in policy.profile_columns() if c not in policy.keys]
    # per row: batch number, first batch of its key, row rank inside its batch
    base = (f"SELECT *, {batch_expr} AS __b, min({batch_expr}) OVER (PARTITION BY {keys}) AS __fb, "
            f"row_number() OVER (PARTITION BY {keys}, {batch_expr} ORDER BY {order}) AS __rk FROM {src}")
    full = (f"(PARTITION BY {keys} ORDER BY __b DESC, {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
    sel = []
    for c in cols:
        kind = types.get(c, "str")
        rule = policy.unify_rules.get(c)
        if policy.merge_rule(c) == INSERT_ONLY:
            fn = "first_value" if rule in (NEWEST, ROW) else "last_value"
            if rule == ROW:
                # top row of the first batch, nulls included: exactly one row has the flag
                v = f"max(CASE WHEN __rk = 1 AND __b = __fb THEN {c} END) OVER (PARTITION BY {keys})"
            else:
                v = f"{fn}(CASE WHEN __b = __fb THEN {c} END IGNORE NULLS) OVER {full}"
            sel.append(f"{v} AS {c}")
            continue
        if rule == ROW:
            cand = f"CASE WHEN __rk = 1 THEN {c} END"
        else:
            cand = c
        win = full
        if rule == OLDEST:  # newest batch first, oldest row first inside it
            win = (f"(PARTITION BY {keys} ORDER BY __b DESC, {_order(policy, reverse=True)} "
                   f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
        val = f"first_value({cand} IGNORE NULLS) OVER {win}"
        vb = f"first_value(CASE WHEN ({cand}) IS NOT NULL THEN __b END IGNORE NULLS) OVER {win}"
        sel.append(f"CASE WHEN {_is_marker(val, kind)} AND {vb} > __fb THEN NULL ELSE {val} END AS {c}")
    return (f"SELECT {keys}, {', '.join(sel)} FROM ({base}) "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY __b DESC, {order}) = 1")


# ------------------------------------------------------------- registry -----

SLICES = 4
_KEYS = "uid, utype"
_FEED_COLS = "uid, utype, epoch, createddate, epoch_ts, cid, att1, att2, att3, ad"


def _with_run(feed_sql: str, tail: str, merge_opts: dict | None = None) -> str:
    return f"""WITH {two_slices(feed_sql)},
m AS ({merge_sql('u1', 'u2', FEED_POLICY, with_state=True, **(merge_opts or {}))})
{tail}"""


def _marker_any(prefix: str = "") -> str:
    p = prefix
    return (f"(coalesce({p}att1 = '{MARK}', false) OR coalesce({p}att2 = {MARK}, false) "
            f"OR coalesce({p}att3 = {MARK}, false))")


def _labelled(col: str, bounds: list[str], first_open: bool) -> str:
    cases = " ".join(f"WHEN {col} <= {b} THEN {i + 1}" for i, b in enumerate(bounds[1:]))
    lower = "" if first_open else f"{col} > {bounds[0]} AND "
    return f"CASE {cases} END AS slice_no", f"{lower}{col} <= {bounds[-1]}"


def slice_epoch_sql() -> str:
    hi = "(SELECT max(epoch) FROM feed)"
    bounds = ["-1"] + [f"(-1 + ({hi} + 1) * {i} // {SLICES})" for i in range(1, SLICES)] + [hi]
    label, where = _labelled("epoch", bounds, first_open=False)
    return f"WITH feed AS ({profile_feed_sql()}) SELECT {_FEED_COLS}, {label} FROM feed WHERE {where}"


def slice_timestamp_sql() -> str:
    lo = "(SELECT epoch_us(min(epoch_ts)) FROM feed)"
    hi = "(SELECT epoch_us(max(epoch_ts)) FROM feed)"
    bounds = ["NULL"] + [f"make_timestamp({lo} + ({hi} - {lo}) * {i} // {SLICES})" for i in range(1, SLICES)]
    bounds.append(f"make_timestamp({hi})")
    label, where = _labelled("epoch_ts", bounds, first_open=True)
    return f"WITH feed AS ({profile_feed_sql()}) SELECT {_FEED_COLS}, {label} FROM feed WHERE {where}"


def oracles() -> dict[str, str]:
    feed = profile_feed_sql()
    pcols = profile_cols()
    o: dict[str, str] = {}
    whole_unify = f"WITH feed AS ({feed}) {unify_sql('feed', FEED_POLICY)}"
    o["unify"] = whole_unify
    o["unify_newest"] = f"SELECT {_KEYS}, att1, att2, att3 FROM ({whole_unify})"
    o["unify_oldest"] = f"SELECT {_KEYS}, ad FROM ({whole_unify})"
    o["unify_named_window"] = f"SELECT {_KEYS}, cid, att1, ad, createddate FROM ({whole_unify})"
    o["top1_per_key"] = f"WITH feed AS ({feed}) {top1_sql('feed', FEED_POLICY, _FEED_COLS.split(', '))}"
    o["unify_skewed"] = f"WITH feed AS ({profile_feed_sql(skewed=True)}) {unify_sql('feed', FEED_POLICY)}"
    o["unify_wide"] = f"WITH feed AS ({wide_feed_sql()}) {unify_sql('feed', wide_policy())}"

    o["unify_merge"] = flagship_sql()
    o["merge_upsert"] = flagship_sql()
    wide = wide_load_policy()
    o["wide_unify_merge"] = (f"WITH {two_slices(wide_load_sql(), wide)}, m AS ({merge_sql('u1', 'u2', wide, {'createddate': 'other'})}) "
                             f"SELECT {profile_cols(wide)} FROM m")
    narrow = Rules({"tiny": NEWEST, "dec": NEWEST})
    o["merge_narrow_types"] = (f"WITH {two_slices(narrow_feed_sql(), narrow)}, m AS ({merge_sql('u1', 'u2', narrow, {'tiny': 'other', 'dec': 'other'})}) "
                               f"SELECT uid, utype, tiny, CAST(dec AS DOUBLE) AS dec FROM m")
    o["merge_match"] = f"WITH {two_slices(feed)} SELECT {_KEYS} FROM u2 WHERE EXISTS " \
                       f"(SELECT 1 FROM u1 WHERE u1.uid = u2.uid AND u1.utype = u2.utype)"
    o["merge_new_keys"] = f"WITH {two_slices(orders_feed_sql())} SELECT {_KEYS} FROM u2 WHERE NOT EXISTS " \
                          f"(SELECT 1 FROM u1 WHERE u1.uid = u2.uid AND u1.utype = u2.utype)"
    o["merge_patch"] = _with_run(feed, f"SELECT {_KEYS}, cid, att1, att2, att3 FROM m WHERE __state = 'updated'")
    o["merge_clear_marker"] = _with_run(
        feed, f"SELECT m.uid, m.utype, m.att1, m.att2, m.att3 FROM m WHERE __state = 'updated' AND EXISTS "
              f"(SELECT 1 FROM u2 WHERE u2.uid = m.uid AND u2.utype = m.utype AND {_marker_any('u2.')})")
    o["merge_insert_only"] = _with_run(feed, f"SELECT {_KEYS}, ad FROM m")
    o["merge_marker_on_insert"] = _with_run(
        orders_feed_sql(), f"SELECT {_KEYS}, att1, att2, att3 FROM m WHERE __state = 'inserted' AND {_marker_any()}")
    o["merge_marker_key"] = _with_run(profile_feed_sql(marker_key=True), f"SELECT {pcols} FROM m",
                                      {"null_marker_keys": True})
    o["merge_row_counts"] = _with_run(feed, """SELECT
  CAST(coalesce(sum(CASE WHEN __state = 'updated' THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_updated,
  CAST(coalesce(sum(CASE WHEN __state = 'inserted' THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_inserted,
  CAST(coalesce(sum(CASE WHEN __state IN ('updated', 'inserted') THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_affected,
  CAST(coalesce(sum(CASE WHEN __state = 'untouched' THEN 1 ELSE 0 END), 0) AS BIGINT) AS rows_untouched,
  count(*) AS rows_total
FROM m""")
    o["out_of_order_batches"] = _with_run(orders_feed_sql(), f"SELECT {pcols} FROM m")

    o["high_water_footer"] = f"WITH feed AS ({feed}) SELECT max(epoch) AS high_water FROM feed"
    o["slice_clustered"] = slice_timestamp_sql().replace("SELECT uid, utype", "SELECT * EXCLUDE (slice_no) FROM (SELECT uid, utype", 1) + ") WHERE slice_no = 2"
    o["high_water_epoch"] = f"WITH feed AS ({feed}) SELECT coalesce(max(epoch), 0) AS high_water FROM feed"
    o["high_water_ts"] = f"WITH feed AS ({feed}) SELECT max(epoch_ts) AS high_water FROM feed"
    o["slice_epoch"] = slice_epoch_sql()
    o["slice_timestamp"] = slice_timestamp_sql()
    o.update(io_oracles())
    return o


# ------------------------------------------------------- loads / writes -----

ARRIVALS = 4
ROWS_PER_OBJECT = 1000
_UNIFIED_COLS = "uid, utype, cid, att1, att2, att3, ad, createddate"
_LOAD_COLS = "uid, utype, createddate, cid, att1, att2, att3, ad"


def _arrival_case(col: str = "epoch") -> str:
    hi = "(SELECT max(epoch) FROM feed)"
    bounds = ["-1"] + [f"(-1 + ({hi} + 1) * {i} // {ARRIVALS})" for i in range(1, ARRIVALS)] + [hi]
    whens = " ".join(f"WHEN {col} <= {b} THEN {i + 1}" for i, b in enumerate(bounds[1:]))
    return f"CASE {whens} END"


def _late_ctes(feed: str) -> str:
    return f"""feed AS ({feed}),
t AS (SELECT *, {_arrival_case()} AS arrival_no FROM feed),
marks AS (SELECT arrival_no, max(epoch_ts) AS m FROM t GROUP BY arrival_no),
prev AS (SELECT arrival_no, max(m) OVER (ORDER BY arrival_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         AS mark_at_arrival FROM marks)"""


def replay_arrivals_sql(feed: str) -> str:
    return (f"WITH feed AS ({feed}) SELECT {profile_cols()} FROM ("
            f"{replay_sql('feed', FEED_POLICY, _arrival_case())})")


def _dirty_feed(feed: str) -> str:
    """The feed as the loader returns it: the text edits of the object writer applied,
    with the reject reason of every row (NULL for loaded rows)."""
    return f"""SELECT uid, utype, createddate, cid,
  CASE WHEN epoch % 79 = 3 THEN '"' || att1 WHEN epoch % 73 = 4 THEN att1 || ',x\\y' ELSE att1 END AS att1,
  att2, att3, ad, epoch // {ROWS_PER_OBJECT} AS object_no,
  CASE WHEN epoch % 97 = 5 THEN 'short row' WHEN epoch % 89 = 7 THEN 'long row'
       WHEN epoch % 83 = 11 THEN 'unparsable att2' END AS reason
FROM ({feed})"""


def io_oracles() -> dict[str, str]:
    feed = profile_feed_sql()
    o: dict[str, str] = {}
    o["incremental_unify_merge"] = replay_arrivals_sql(feed)
    o["stream_unify_merge"] = replay_arrivals_sql(feed)
    o["resume_from_checkpoint"] = replay_arrivals_sql(feed)
    for same in ("restart_batch_loop", "crash_before_commit", "stream_split_load", "poll_older_load", "stream_load_gap"):
        o[same] = replay_arrivals_sql(feed)
    loads = f"""WITH feed AS ({feed}), t AS (SELECT *, {_arrival_case()} AS a FROM feed),
k AS (SELECT DISTINCT a, uid, utype FROM t),
n AS (SELECT a, count(*) AS keys FROM k GROUP BY a),
m AS (SELECT a, max(epoch) AS hi FROM t GROUP BY a),
b AS (SELECT row_number() OVER (ORDER BY a) - 1 AS batch_id, lag(hi) OVER (ORDER BY a) AS lo, hi, keys FROM m JOIN n USING (a))"""
    o["run_metrics"] = (f"{loads} SELECT s.step, batch_id, lo, hi, CASE WHEN s.step <> 'cycle' THEN keys END AS rows "
                        f"FROM b, (VALUES ('unify'), ('merge'), ('cycle')) s(step)")
    o["staging_reset"] = f"{loads} SELECT batch_id, keys AS rows_staged, 0 AS rows_after FROM b"
    o["run_metrics_summary"] = """WITH e AS (SELECT event_type AS step, user_id, (event_id * 7919 + user_id) % 100003 AS d FROM events)
SELECT step, count(*) AS runs, min(d) AS min_ns, max(d) AS max_ns, CAST(sum(d) AS BIGINT) AS total_ns,
       CAST(sum(d) // count(*) AS BIGINT) AS avg_ns, CAST(sum(user_id) AS BIGINT) AS rows FROM e GROUP BY step"""
    o["incremental_append"] = (f"WITH {_late_ctes(feed)} SELECT {_FEED_COLS} FROM t JOIN prev USING (arrival_no) "
                               f"WHERE mark_at_arrival IS NULL OR epoch_ts > mark_at_arrival")
    o["late_rows_report"] = (f"WITH {_late_ctes(feed)} SELECT epoch, epoch_ts, arrival_no, mark_at_arrival "
                             f"FROM t JOIN prev USING (arrival_no) WHERE epoch_ts <= mark_at_arrival")
    o["overlap_append"] = (f"WITH {_late_ctes(feed)} SELECT {_FEED_COLS} FROM t JOIN prev USING (arrival_no) "
                           f"WHERE mark_at_arrival IS NULL OR epoch_ts > mark_at_arrival - INTERVAL 30 MINUTE")
    for whole in ("stream_archive", "stream_overlap_append"):
        o[whole] = f"WITH feed AS ({feed}) SELECT {_FEED_COLS} FROM feed"
    clear = lambda c, mark: f"CASE WHEN {c} = {mark} THEN NULL ELSE {c} END AS {c}"
    o["merge_event_time"] = (f"WITH feed AS ({orders_feed_sql()}), u AS ({unify_sql('feed', FEED_POLICY)}) "
                             f"SELECT {_KEYS}, cid, {clear('att1', repr(MARK))}, {clear('att2', MARK)}, {clear('att3', MARK)}, ad FROM u")
    o["stream_metrics"] = f"""WITH feed AS ({feed}), t AS (SELECT *, {_arrival_case()} - 1 AS a FROM feed),
f AS (SELECT uid, utype, min(a) AS first FROM t GROUP BY uid, utype), k AS (SELECT DISTINCT a, uid, utype FROM t),
c AS (SELECT a, count(*) FILTER (WHERE a = first) AS inserted, count(*) FILTER (WHERE a > first) AS updated FROM k JOIN f USING (uid, utype) GROUP BY a)
SELECT CAST(a AS BIGINT) AS batch_id, count(*) AS input_rows, any_value(inserted) AS inserted, any_value(updated) AS updated FROM t JOIN c USING (a) GROUP BY a"""
    o["slice_append"] = f"WITH feed AS ({feed}) SELECT {_FEED_COLS} FROM feed"
    o["stream_append"] = f"WITH feed AS ({feed}) SELECT {_FEED_COLS} FROM feed"
    o["align_insert"] = (f"WITH feed AS ({feed}) SELECT uid, utype, CAST(NULL AS BIGINT) AS epoch, createddate, "
                         f"CAST(NULL AS TIMESTAMP) AS epoch_ts, cid, att1, att2, att3, ad "
                         f"FROM ({unify_sql('feed', FEED_POLICY)})")
    dirty = _dirty_feed(feed)
    o["ingest_delimited"] = f"SELECT {_LOAD_COLS} FROM ({dirty}) WHERE reason IS NULL"
    o["stream_ingest"] = f"SELECT {_LOAD_COLS} FROM ({dirty}) WHERE reason IS NULL"
    o["ingest_multi_file"] = f"SELECT object_no, {_LOAD_COLS} FROM ({dirty}) WHERE reason IS NULL"
    o["ingest_stamped"] = (f"SELECT object_no, {_LOAD_COLS}, object_no AS epoch, "
                           f"TIMESTAMP '2024-01-01 00:00:00' + to_seconds(object_no) AS epoch_ts FROM ({dirty}) WHERE reason IS NULL")
    o["ingest_rejects"] = (f"SELECT object_no, reason, count(*) AS rows FROM ({dirty}) "
                           f"WHERE reason IS NOT NULL GROUP BY object_no, reason")
    o["ingest_file_stats"] = (f"SELECT object_no, count(*) FILTER (WHERE reason IS NULL) AS rows_loaded, "
                              f"count(*) FILTER (WHERE reason IS NOT NULL) AS rows_rejected "
                              f"FROM ({dirty}) GROUP BY object_no")
    o["ingest_bad_object"] = (f"SELECT object_no, count(*) FILTER (WHERE reason IS NULL) AS rows_loaded, count(*) FILTER (WHERE reason IS NOT NULL) AS rows_rejected, "
                              f"'loaded' AS state FROM ({dirty}) GROUP BY object_no "
                              f"UNION ALL SELECT 900000001, 0, 0, 'unreadable' UNION ALL SELECT 900000002, 0, 0, 'empty'")
    per_object = (f"SELECT object_no, count(*) FILTER (WHERE reason IS NULL) AS rows_loaded, count(*) FILTER (WHERE reason IS NOT NULL) AS rows_rejected, 'loaded' AS state, "
                  f"count(*) FILTER (WHERE reason IS NULL) AS rows_read FROM ({dirty}) GROUP BY object_no")
    o["ingest_truncated_object"] = (f"WITH p AS ({per_object}) SELECT * FROM p UNION ALL SELECT 900000004, rows_loaded, rows_rejected, state, rows_read FROM p WHERE object_no = 0 "
                                    f"UNION ALL SELECT 900000003, 0, 0, 'unreadable', 0")
    # a line counts from its object's second 7n on; seconds in which an object is being read, without counting any twice
    o["copy_metrics"] = f"""WITH d AS ({dirty}), s AS (SELECT object_no, min(object_no * 7 + uid % (object_no % 12 + 1)) AS lo, max(object_no * 7 + uid % (object_no % 12 + 1)) AS hi,
  count(*) FILTER (WHERE reason IS NULL) AS n FROM d GROUP BY object_no),
sec AS (SELECT DISTINCT unnest(range(lo, hi)) AS x FROM s)
SELECT 'copy' AS step, count(*) AS runs, CAST(min(hi - lo) * 1000000000 AS BIGINT) AS min_ns, CAST(max(hi - lo) * 1000000000 AS BIGINT) AS max_ns,
       CAST((SELECT count(*) FROM sec) * 1000000000 AS BIGINT) AS total_ns, CAST(sum(hi - lo) * 1000000000 // count(*) AS BIGINT) AS avg_ns, CAST(sum(n) AS BIGINT) AS rows FROM s"""
    o["ingest_control_chars"] = (f"SELECT uid, utype, createddate, cid, CASE WHEN epoch % 3 = 1 THEN chr(1) || att1 || '\\,' || chr(2) || '\\' ELSE att1 END AS att1, "
                                 f"att2, att3, ad FROM ({feed})")
    o["wide_ingest"] = f"SELECT * EXCLUDE (epoch) FROM ({wide_load_sql()})"
    o["ingest_manifest"] = (f"SELECT DISTINCT object_no, true AS present FROM ({dirty}) "
                            f"UNION ALL SELECT CAST(NULL AS BIGINT) AS object_no, false AS present")
    return o
