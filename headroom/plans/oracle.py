"""DuckDB SQL that gives the rows of the registered queries, written from the same definitions."""

from __future__ import annotations

from ..functions import scalars as C
from ..sources.adapters import KEYS

SERIES = "metric, hostid, host, as_value, env_value, env_group"
KEY = ("metric", "hostid", "host", "as_value", "env_value", "env_group")


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_ROTATED = " ".join(f"WHEN {r} THEN {_list(k[r % len(k)] for k in KEYS)}" for r in range(5))

#: Parts that queries build on: name to (SQL, names that it needs).
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "hosts": (
        """SELECT CAST(s_suppkey AS VARCHAR) hostid, s_suppkey k, s_nationkey nk,
        replace(lower(s_name), '#', '-') || CASE s_suppkey % 3 WHEN 0 THEN '.ops.example.com' WHEN 1 THEN '.example.org' ELSE '' END host, s_name AS name,
        CASE WHEN s_suppkey % 11 = 5 THEN '1' ELSE '0' END status,
        CASE WHEN s_suppkey % 5 = 0 THEN CAST([] AS VARCHAR[]) WHEN s_suppkey % 7 = 0 THEN ['AS-9', 'AS-' || (s_nationkey % 4)] ELSE ['AS-' || (s_nationkey % 4)] END tags,
        CASE WHEN s_suppkey % 4 = 0 THEN 'prod' WHEN s_suppkey % 4 = 1 THEN 'Prod' ELSE 'dev' END env FROM supplier""",
        (),
    ),
    "scope": ("SELECT hostid, host, tags[1] as_value, env env_value, CASE WHEN lower(env) = 'prod' THEN 'prod' ELSE 'non-prod' END env_group FROM hosts WHERE status = '0' AND len(tags) > 0", ("hosts",)),
    "items": (
        f"""SELECT CAST(s_suppkey * 100 + pos AS VARCHAR) itemid, CAST(s_suppkey AS VARCHAR) hostid, s_suppkey k, pos,
        CASE WHEN pos = 1 THEN 'CPU utilization' ELSE 'Item ' || pos END AS name, key_, 0 value_type,
        CASE WHEN pos = 3 AND s_suppkey % 6 = 1 THEN '1' ELSE '0' END status, CASE WHEN pos % 2 = 0 THEN '%' ELSE '' END units,
        CASE pos % 4 WHEN 0 THEN '/var/lib/app' || s_suppkey || '/data.log,x /etc/app/app.conf' WHEN 1 THEN '12.5' WHEN 2 THEN 'postgres https://h.example/x/y /opt/cache/f.pem /proc/1/x /usr/bin/tool' ELSE '' END lastvalue,
        CASE WHEN pos % 5 = 0 THEN NULL ELSE strftime(make_timestamp((1700000000 + s_suppkey * 60 + pos) * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') END lastclock
        FROM (SELECT s_suppkey, unnest(ks) key_, generate_subscripts(ks, 1) pos FROM (SELECT s_suppkey, CASE s_suppkey % 5 {_ROTATED} END ks FROM supplier))""",
        (),
    ),
    "enabled": ("SELECT * FROM items WHERE status = '0'", ("items",)),
    "cpu": (
        r"""SELECT hostid, itemid, key_, value_type, score, transform FROM (SELECT *, row_number() OVER (PARTITION BY hostid ORDER BY score DESC, CAST(itemid AS BIGINT)) rn FROM (
        SELECT hostid, itemid, key_, value_type, CASE WHEN len(a) = 0 THEN 170 WHEN list_contains(a, 'idle') THEN 220 + CASE WHEN list_contains(a, 'all') THEN 15 ELSE 0 END
          + CASE WHEN list_contains(a, 'avg5') THEN 15 WHEN list_contains(a, 'avg1') THEN 10 WHEN list_contains(a, 'avg15') THEN 5 ELSE 0 END END
          + CASE WHEN contains(lower(name), 'cpu utilization') THEN 10 ELSE 0 END score, CASE WHEN len(a) = 0 THEN 'identity' ELSE 'invert_100' END transform
        FROM (SELECT *, list_filter(list_transform(string_split(regexp_extract(key_, '^system\.cpu\.util(?:\[(.*)\])?$', 1), ','), lambda x: lower(trim(x))), lambda x: x <> '') a
              FROM enabled WHERE regexp_matches(key_, '^system\.cpu\.util(?:\[(.*)\])?$'))) WHERE score IS NOT NULL) WHERE rn = 1""",
        ("enabled",),
    ),
    "ram": (
        """SELECT hostid, role, itemid, key_, value_type, score FROM (SELECT *, row_number() OVER (PARTITION BY hostid, role ORDER BY score DESC, CAST(itemid AS BIGINT)) rn FROM (
        SELECT hostid, itemid, key_, value_type, CASE WHEN key_ = 'vm.memory.size[total]' THEN 'total' WHEN key_ IN ('vm.memory.size[available]', 'vm.memory.size[free]') THEN 'available' WHEN key_ = 'vm.memory.size[used]' THEN 'used'
          WHEN starts_with(key_, 'vm.memory.size[pavailable') THEN 'pavailable' WHEN starts_with(key_, 'vm.memory.size[pused') THEN 'pused' END AS role,
        CASE WHEN key_ = 'vm.memory.size[free]' THEN 210 WHEN key_ = 'vm.memory.size[pavailable]' THEN 250 WHEN starts_with(key_, 'vm.memory.size[pavailable') THEN 240 WHEN key_ = 'vm.memory.size[pused]' THEN 180 WHEN starts_with(key_, 'vm.memory.size[pused') THEN 170 ELSE 220 END score
        FROM enabled WHERE starts_with(key_, 'vm.memory.size[')) WHERE role IS NOT NULL) WHERE rn = 1""",
        ("enabled",),
    ),
    "disk": (
        r"""SELECT m.hostid, m.entity, b.score, m.mode, m.itemid, m.key_, m.value_type FROM (
          SELECT hostid, entity, mode, itemid, key_, value_type FROM (SELECT *, row_number() OVER (PARTITION BY hostid, entity, mode ORDER BY CAST(itemid AS BIGINT)) n FROM fs) WHERE n = 1) m
        JOIN (SELECT hostid, entity, score FROM (SELECT *, row_number() OVER (PARTITION BY hostid ORDER BY score DESC, first) rn FROM (
          SELECT hostid, entity, min(CAST(itemid AS BIGINT)) AS first, CASE WHEN entity = '/' THEN 1000 WHEN entity = 'C:' THEN 999 WHEN starts_with(upper(entity), 'C') THEN 650 ELSE 500 END score
          FROM fs GROUP BY hostid, entity HAVING bool_or(mode = 'pused'))) WHERE rn = 1) b USING (hostid, entity)""",
        ("fs",),
    ),
    "fs": (r"SELECT hostid, itemid, key_, value_type, regexp_extract(key_, '^vfs\.fs\.size\[(.*),(pused|used|free|total)\]$', 1) entity, regexp_extract(key_, '^vfs\.fs\.size\[(.*),(pused|used|free|total)\]$', 2) AS mode FROM enabled WHERE regexp_matches(key_, '^vfs\.fs\.size\[(.*),(pused|used|free|total)\]$')", ("enabled",)),
    "selected": (
        """SELECT x.hostid, s.host, s.as_value, s.env_value, s.env_group, metric, source, feature, entity, itemid, key_, value_type, transform FROM (
        SELECT hostid, 'cpu' metric, 'target' AS source, '' feature, '' entity, itemid, key_, value_type, transform FROM cpu
        UNION ALL SELECT hostid, 'ram', 'target', '', '', itemid, key_, value_type, 'invert_100' FROM ram WHERE role = 'pavailable'
        UNION ALL SELECT hostid, 'ram', 'feature', CASE role WHEN 'pavailable' THEN 'pavailable_pct' WHEN 'pused' THEN 'pused_pct' ELSE role || '_bytes' END, '', itemid, key_, value_type, 'identity' FROM ram
        UNION ALL SELECT hostid, 'disk', 'target', '', entity, itemid, key_, value_type, 'identity' FROM disk WHERE mode = 'pused'
        UNION ALL SELECT hostid, 'disk', 'feature', CASE mode WHEN 'pused' THEN 'pused_pct' ELSE mode || '_bytes' END, entity, itemid, key_, value_type, 'identity' FROM disk) x JOIN scope s USING (hostid)""",
        ("cpu", "ram", "disk", "scope"),
    ),
    "trend": (
        """SELECT CAST(l_suppkey * 100 + l_linenumber AS VARCHAR) itemid, l_shipdate clock, CASE WHEN l_linenumber = 3 THEN 0 ELSE l_linenumber END num,
        CASE WHEN l_quantity = 7 THEN NULL ELSE l_quantity END value_min, l_quantity * (1 + l_tax) value_avg, l_quantity * 2 value_max FROM lineitem WHERE l_quantity NOT IN (13, 14)""",
        (),
    ),
    "util_h": (
        """SELECT CASE WHEN event_type = 'click' THEN 'cpu' WHEN event_type = 'view' THEN 'ram' ELSE 'disk' END metric, date_trunc('hour', ts) clock, CAST(user_id AS VARCHAR) hostid, 'host-' || user_id host, 'AS-' || (user_id % 3) as_value,
        CASE WHEN user_id % 4 = 0 THEN 'PROD' ELSE 'dev' END env_value, CASE WHEN user_id % 4 = 0 THEN 'prod' ELSE 'non-prod' END env_group, least(value, 100) v FROM events""",
        (),
    ),
    "util_t": ("SELECT metric, clock, hostid, host, as_value, env_value, env_group, count(v) num, min(v) lo, avg(v) av, max(v) hi FROM util_h GROUP BY ALL", ("util_h",)),
    "load": (
        """SELECT 'cpu' metric, CAST(l_suppkey AS VARCHAR) hostid, 'host-' || l_suppkey host, 'AS-' || (l_suppkey % 2) as_value, CASE WHEN l_suppkey % 4 = 0 THEN 'prod' ELSE 'dev' END env_value,
        CASE WHEN l_suppkey % 4 = 0 THEN 'prod' ELSE 'non-prod' END env_group, l_shipdate clock, l_quantity * (1 + l_suppkey % 3 / 2) v FROM lineitem""",
        (),
    ),
    "daily": (f"SELECT {SERIES}, CAST(clock AS DATE) date, quantile_cont(v, 0.95) y FROM load GROUP BY ALL", ("load",)),
    "grid": (
        f"""SELECT {SERIES}, date + CAST(k AS INTEGER) date, least(greatest(CASE WHEN k = 0 THEN y ELSE y + (y2 - y) * k / span END, 0), 100) y FROM (
        SELECT *, unnest(range(0, greatest(coalesce(span, 1), 1))) k FROM (SELECT *, lead(y) OVER w y2, lead(date) OVER w - date span FROM daily WINDOW w AS (PARTITION BY {SERIES} ORDER BY date)))""",
        ("daily",),
    ),
    "naive": (
        f"""SELECT h.metric, h.hostid, h.host, h.as_value, h.env_value, h.env_group, h.last + CAST(d AS INTEGER) date, d horizon_day, w.y p50, least(w.y + h.q90, 100) p90, least(w.y + h.q95, 100) p95 FROM (
          SELECT {SERIES}, max(date) AS last, quantile_cont(r, 0.9) q90, quantile_cont(r, 0.95) q95 FROM (SELECT *, abs(y - lag(y, 7) OVER (PARTITION BY {SERIES} ORDER BY date)) r FROM grid) GROUP BY ALL) h
        CROSS JOIN (SELECT unnest(range(1, 366)) d) x JOIN grid w ON w.metric = h.metric AND w.hostid = h.hostid AND w.date = h.last - 6 + CAST((d - 1) % 7 AS INTEGER)""",
        ("grid",),
    ),
    "placed": (f"SELECT *, abs(y - lag(y, 7) OVER w) r, row_number() OVER w - 1 i, count(*) OVER (PARTITION BY {SERIES}) n FROM grid WINDOW w AS (PARTITION BY {SERIES} ORDER BY date)", ("grid",)),
    "backtest": (
        f"""SELECT {SERIES}, avg(wape) wape, avg(mae) mae, avg(pinball) pinball, avg(calibration) calibration, count(*) folds FROM (
        SELECT t.metric, t.hostid, t.host, t.as_value, t.env_value, t.env_group, f.fold, sum(abs(t.y - w.y)) / sum(abs(t.y)) wape, avg(abs(t.y - w.y)) mae,
          avg(CASE WHEN t.y >= least(w.y + q.q90, 100) THEN 0.9 * (t.y - least(w.y + q.q90, 100)) ELSE -0.1 * (t.y - least(w.y + q.q90, 100)) END) pinball, avg(CAST(t.y <= least(w.y + q.q90, 100) + 1e-9 AS INTEGER)) calibration
        FROM placed t JOIN (SELECT unnest([1, 2, 3]) fold) f ON t.n - f.fold * 30 >= 90 AND t.n >= 120 AND t.i >= t.n - f.fold * 30 AND t.i < t.n - f.fold * 30 + 30
        JOIN placed w ON w.metric = t.metric AND w.hostid = t.hostid AND w.i = t.n - f.fold * 30 - 7 + (t.i - (t.n - f.fold * 30)) % 7
        JOIN (SELECT metric, hostid, fold, quantile_cont(r, 0.9) q90 FROM placed JOIN (SELECT unnest([1, 2, 3]) fold) ON i < n - fold * 30 GROUP BY ALL) q ON q.metric = t.metric AND q.hostid = t.hostid AND q.fold = f.fold
        GROUP BY ALL) GROUP BY ALL""",
        ("placed",),
    ),
    "line0": ("SELECT metric, hostid, fold, CAST(i AS DOUBLE) i, y, isodow(date) w, CAST(1 AS DOUBLE) q FROM placed JOIN (SELECT unnest([1, 2, 3]) fold) ON i < n - fold * 30 AND n - fold * 30 >= 90 AND n >= 120", ("placed",)),
    "crossing": (
        "SELECT metric, hostid, env_value, env_group, min(date) d0, "
        + ", ".join(f"min(CASE WHEN {c} >= {t} THEN date END) date_{t}_{c}, min(CASE WHEN {c} >= {t} THEN date END) - min(date) + 1 days_to_{t}_{c}" for c in ("p50", "p90", "p95") for t in (80, 90, 95))
        + " FROM naive GROUP BY metric, hostid, env_value, env_group",
        ("naive",),
    ),
}


_FIT = "metric, hostid, fold"
for _k in range(1, 9):  # the passes of the reweighted line
    PARTS[f"solved{_k}"] = (
        f"""SELECT {_FIT}, m, (t0 - m * s1) / s0 c FROM (SELECT *, (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) m FROM (
        SELECT {_FIT}, sum(q) s0, sum(q * i) s1, sum(q * i * i) s2, sum(q * y) t0, sum(q * i * y) t1 FROM line{_k - 1} GROUP BY ALL))""",
        (f"line{_k - 1}",),
    )
    PARTS[f"rest{_k}"] = (f"SELECT {_FIT}, i, y, w, s.c, s.m, y - (s.c + s.m * i) r FROM line{_k - 1} JOIN solved{_k} s USING ({_FIT})", (f"line{_k - 1}", f"solved{_k}"))
    PARTS[f"line{_k}"] = (
        f"SELECT {_FIT}, i, y, w, c, m, r, 1 / pow(greatest(1, abs(r) / (1.5 * (s + 1e-9))), 2) q FROM rest{_k} JOIN (SELECT {_FIT}, quantile_cont(abs(r), 0.5) s FROM rest{_k} GROUP BY ALL) USING ({_FIT})",
        (f"rest{_k}",),
    )
PARTS["trend_backtest"] = (
    f"""SELECT {SERIES}, avg(wape) wape, avg(mae) mae, avg(pinball) pinball, avg(calibration) calibration, count(*) folds FROM (
    SELECT {SERIES}, fold, sum(abs(y - f)) / sum(abs(y)) wape, avg(abs(y - f)) mae, avg(CASE WHEN y >= g THEN 0.9 * (y - g) ELSE -0.1 * (y - g) END) pinball, avg(CAST(y <= g + 1e-9 AS INTEGER)) calibration FROM (
      SELECT *, least(greatest(f + q90, 0), 100) g FROM (SELECT t.*, e.fold, e.q90, least(greatest(e.c + e.m * t.i + d.term, 0), 100) f FROM placed t
      JOIN (SELECT {_FIT}, any_value(c) c, any_value(m) m, quantile_cont(abs(r), 0.9) q90 FROM line8 GROUP BY ALL) e ON e.metric = t.metric AND e.hostid = t.hostid AND t.i >= t.n - e.fold * 30 AND t.i < t.n - e.fold * 30 + 30
      JOIN (SELECT {_FIT}, w, quantile_cont(r, 0.5) term FROM line8 GROUP BY ALL) d ON d.metric = t.metric AND d.hostid = t.hostid AND d.fold = e.fold AND d.w = isodow(t.date))) GROUP BY ALL) GROUP BY ALL""",
    ("placed", "line8"),
)


def _risk(of: str) -> str:
    return f"""SELECT *, CASE WHEN p95 >= 85 OR duty_cycle_90 >= 0.10 THEN 'hot' WHEN p50 <= 35 AND volatility <= 0.45 AND duty_cycle_80 <= 0.05 THEN 'cold' ELSE 'warm' END AS cluster, p95 <= 25 AND duty_cycle_80 <= 0.01 AS overprovisioned FROM (
    SELECT *, p95 - p50 burstiness, CASE WHEN util_mean > 0 THEN util_std / util_mean END volatility FROM (
    SELECT {SERIES}, count(v) point_count, avg(v) util_mean, coalesce(stddev_samp(v), 0) util_std, quantile_cont(v, 0.5) p50, quantile_cont(v, 0.95) p95, quantile_cont(v, 0.99) p99,
      avg(CASE WHEN v >= 80 THEN 1.0 ELSE 0.0 END) duty_cycle_80, avg(CASE WHEN v >= 90 THEN 1.0 ELSE 0.0 END) duty_cycle_90 FROM {of} GROUP BY ALL))"""


PARTS["risk"] = (_risk("load"), ("load",))
PARTS["risk_events"] = (_risk("util_h"), ("util_h",))
PARTS["actions"] = (
    """SELECT *, CASE WHEN status = 'overprovisioned' THEN 'consider consolidating or resizing' WHEN status = 'critical' THEN 'capacity measures needed within 30 days' WHEN status = 'watch' THEN 'plan a capacity extension within 30 to 90 days'
      WHEN basis IS NULL THEN 'no crossing of the threshold expected within the forecast' ELSE 'watch the trend, no immediate action needed' END recommendation FROM (
    SELECT *, CASE WHEN overprovisioned AND cluster = 'cold' THEN 'overprovisioned' WHEN basis < 30 THEN 'critical' WHEN basis <= 90 THEN 'watch' ELSE 'stable' END status FROM (
    SELECT r.*, c.* EXCLUDE (metric, hostid, env_value, env_group), CASE WHEN cluster = 'hot' THEN 'hot_p90_p95' ELSE 'p50' END risk_basis, CASE WHEN cluster = 'hot' THEN least(days_to_90_p90, days_to_90_p95) ELSE days_to_90_p50 END basis,
      CASE WHEN cluster = 'hot' THEN least(date_90_p90, date_90_p95) ELSE date_90_p50 END basis_date FROM risk r LEFT JOIN crossing c ON r.metric = c.metric AND r.hostid = c.hostid AND r.env_value = c.env_value AND r.env_group = c.env_group))""",
    ("risk", "crossing"),
)
PARTS["specs"] = (
    """SELECT hostid, host, as_value, env_value, env_group, metric, h horizon_days, 'native.forecast.util[' || metric || ',' || h || 'd]' key_, '[NativeForecast] ' || upper(metric) || ' utilization +' || h || 'd' AS name,
    CASE WHEN transform = 'invert_100' THEN '100-' ELSE '' END || 'forecast(//' || key_ || ',365d,' || h || 'd,"linear","value")' params, '1h' delay, '%' units, '0' status, 0 value_type, '15' AS type
    FROM selected CROSS JOIN (SELECT unnest([30, 90, 180, 365]) h) WHERE source = 'target'""",
    ("selected",),
)
PARTS["triggers"] = (
    """SELECT hostid, host, metric, '[NativeForecast][' || upper(metric) || '] ' || w.text description,
    CASE WHEN w.b = 0 THEN e(w.h) ELSE '(' || e(w.h) || ') and not (' || e(w.b) || ')' END expression, w.p priority, '0' status,
    'AS=' || as_value || ';ENV=' || env_value || ';ENV_GROUP=' || env_group || ';METRIC=' || metric || ';RISK_WINDOW=' || w.h || 'd;SOURCE=native_forecast;THRESHOLD=90.0' tags
    FROM (SELECT DISTINCT hostid, host, as_value, env_value, env_group, metric FROM specs) CROSS JOIN (SELECT unnest([30, 90, 180, 365]) h, unnest([0, 30, 90, 180]) b, unnest([4, 3, 2, 1]) p,
      unnest(['critical now (<=30d)', 'critical soon (31-90d)', 'risk 6m (91-180d)', 'risk 12m (181-365d)']) AS text) w""".replace("e(w.h)", "'last(/' || host || '/native.forecast.util[' || metric || ',' || w.h || 'd])>=90.0'").replace("e(w.b)", "'last(/' || host || '/native.forecast.util[' || metric || ',' || w.b || 'd])>=90.0'"),
    ("specs",),
)
PARTS["item_diff"] = (
    """SELECT hostid, host, metric, horizon_days, key_, CASE WHEN CAST(hostid AS BIGINT) % 2 = 1 THEN 'create' WHEN CAST(hostid AS BIGINT) % 10 = 4 THEN 'skip_conflict' WHEN CAST(hostid AS BIGINT) % 3 = 0 THEN 'update' ELSE 'noop' END AS action,
    CASE WHEN CAST(hostid AS BIGINT) % 2 = 0 THEN CAST(CAST(hostid AS BIGINT) * 1000 + horizon_days AS VARCHAR) END itemid FROM specs""",
    ("specs",),
)
PARTS["trigger_diff"] = (
    """SELECT hostid, host, metric, description, CASE WHEN CAST(hostid AS BIGINT) % 2 = 1 THEN 'create' WHEN CAST(hostid AS BIGINT) % 3 = 0 THEN 'update' ELSE 'noop' END AS action,
    CASE WHEN CAST(hostid AS BIGINT) % 2 = 0 THEN CAST((SELECT min(CAST(hostid AS BIGINT) * 10 + o.priority) FROM triggers o WHERE o.hostid = t.hostid AND o.description = t.description) AS VARCHAR) END triggerid FROM triggers t""",
    ("triggers",),
)
PARTS["refs"] = (
    """SELECT n_name AS system, 'role-' || (k % 3) AS role, CASE WHEN k % 4 = 3 THEN h.name ELSE h.host END host_ref FROM hosts h JOIN nation ON nk = n_nationkey
    UNION ALL SELECT DISTINCT n_name, 'role-x', 'gone-' || lower(n_name) FROM hosts JOIN nation ON nk = n_nationkey""",
    ("hosts",),
)
PARTS["resolved"] = (
    """SELECT r.*, coalesce(a.hostid, b.hostid) hostid, CASE WHEN a.hostid IS NOT NULL THEN 'host' WHEN b.hostid IS NOT NULL THEN 'name' ELSE 'host_not_found' END matched_by FROM refs r
    LEFT JOIN (SELECT * FROM hosts WHERE status = '0') a ON a.host = r.host_ref LEFT JOIN (SELECT * FROM hosts WHERE status = '0') b ON b.name = r.host_ref""",
    ("refs", "hosts"),
)
PARTS["own"] = ("SELECT * FROM enabled WHERE hostid IN (SELECT hostid FROM resolved WHERE hostid IS NOT NULL)", ("enabled", "resolved"))
_HINT = "regexp_matches(lower(name || ' ' || key_ || ' ' || lastvalue), 'zabbix|grafana|victoria|vminsert|vmselect|vmstorage|vmagent|vmalert|vmauth|postgres|pgsql')"
_PATH = r"(/[A-Za-z0-9._@%+=:,~\-]+(?:/[A-Za-z0-9._@%+=:,~\-]+)*)"


def _unquote(x: str) -> str:
    return f"""trim(trim(trim({x}), '"'), '''')"""


def _first(section: str, value: str, detail: str, where: str, same: str) -> str:
    return f"""SELECT hostid, '{section}' AS section, value, detail, name item_name, key_ item_key, lastvalue, units, lastclock FROM (
    SELECT *, row_number() OVER (PARTITION BY hostid, {same} ORDER BY CAST(itemid AS BIGINT)) rn FROM (SELECT *, {value} AS value, {detail} AS detail FROM own WHERE {where})) WHERE rn = 1"""


def _rx(pattern: str, k: int) -> str:
    return _unquote(f"regexp_extract(key_, '{pattern}', {k})")


_UNIT = r"^systemd\.unit\.(?:get|info)\[(.*?)(?:,(.*?))?\]$"
SECTION_SQL = {
    "services": _first("services", _rx(_UNIT, 1), f"nullif({_rx(_UNIT, 2)}, '')", f"regexp_matches(key_, '{_UNIT}')", "value, detail, lastvalue, key_")
    + " UNION ALL "
    + _first("services", "CAST(NULL AS VARCHAR)", "'process_count'", rf"regexp_matches(key_, '^proc\.num\[(.*)\]$') AND {_HINT}", "name, key_, lastvalue"),
    "filesystems": _first("filesystems", _rx(r"^vfs\.fs\.size\[(.*?),(.*?)\]$", 1), _rx(r"^vfs\.fs\.size\[(.*?),(.*?)\]$", 2), r"regexp_matches(key_, '^vfs\.fs\.size\[(.*?),(.*?)\]$')", "value, detail, key_, lastvalue"),
    "block_devices": _first("block_devices", _rx(r"^vfs\.dev\.(read|write)\[(.*?)\]$", 2), r"regexp_extract(key_, '^vfs\.dev\.(read|write)\[(.*?)\]$', 1)", r"regexp_matches(key_, '^vfs\.dev\.(read|write)\[(.*?)\]$')", "value, detail, key_, lastvalue"),
    "network_interfaces": _first("network_interfaces", _rx(r"^net\.if\.[^(\[]+\[(.*?)(?:,.*)?\]$", 1), "CAST(NULL AS VARCHAR)", r"regexp_matches(key_, '^net\.if\.[^(\[]+\[(.*?)(?:,.*)?\]$')", "value, key_, lastvalue"),
    "ssl_targets": _first("ssl_targets", _rx(r"^web\.certificate\.get\[(.+?)\]$", 1), "CAST(NULL AS VARCHAR)", r"regexp_matches(key_, '^web\.certificate\.get\[(.+?)\]$')", "value, key_, lastvalue"),
    "raw_service_related_items": _first("raw_service_related_items", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", _HINT, "name, key_, lastvalue"),
}
_ITEM_KIND = """CASE WHEN starts_with(lower(path), '/var/log/') OR regexp_matches(lower(path), '\\.(log|out|err)$') THEN 'log_like' WHEN starts_with(lower(path), '/etc/') OR regexp_matches(lower(path), '\\.(conf|ini|yaml|yml|json|toml|cnf|service)$') THEN 'config_like'
    WHEN contains(lower(path), '/cert') OR regexp_matches(lower(path), '\\.(crt|pem|key|cer)$') THEN 'certificate_like' WHEN contains(lower(path), '/bin/') OR contains(lower(path), '/sbin/') THEN 'binary_like'
    WHEN regexp_matches(lower(path), '/var/lib/|data|pg_wal|tablespace') THEN 'data_like' ELSE 'other' END"""
_FILE_KIND = """CASE WHEN regexp_matches(lower(path), '\\.(crt|cer|pem|der|key|p12|pfx)$') THEN 'cert_file' WHEN regexp_matches(lower(path), '/log/|/logs/|\\.log\\.|\\.log$') THEN 'log_file'
    WHEN starts_with(lower(path), '/etc') OR regexp_matches(lower(path), '\\.(conf|ini|cfg|yaml|yml|json|xml|properties|service|target|socket|timer|mount|slice)$') THEN 'config_file'
    WHEN regexp_matches(lower(path), '^(/usr|/usr/local)?/s?bin/|\\.(sh|py|pl|rb)$') THEN 'binary_file' WHEN regexp_matches(lower(path), '^/(var/lib|var/opt|var/www|srv|home|opt)') THEN 'data_file' ELSE 'other' END"""
_DUMP_KIND = """CASE WHEN regexp_matches(lower(path), '[^/]\\.(crt|pem|cer|key|pfx)$') OR regexp_matches(lower(path), '/(ssl|pki|certs|cert)(/|$)') THEN 'certificate' WHEN contains(path, 'var/log') OR regexp_matches(lower(path), '[^/]\\.(log|gz|journal)$') THEN 'log'
    WHEN starts_with(path, '/etc') THEN 'config' WHEN regexp_matches(path, '^/(var/lib|srv|data)') THEN 'data' WHEN regexp_matches(path, '^/(usr/bin|usr/sbin|bin|sbin|opt)') THEN 'binary' ELSE 'other' END"""
_PARENT = "CASE WHEN regexp_replace(path, '/[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '/[^/]*$', '') END"
_SAFE = "path NOT IN ('/', '/var', '/etc', '/usr', '/opt') AND NOT regexp_matches(path, '^/(proc|sys|dev|run|tmp)/')"
PARTS["found_paths"] = (
    f"""SELECT hostid, path, {_ITEM_KIND} kind, name item_name, key_ item_key, lastvalue, units, lastclock FROM (SELECT *, row_number() OVER (PARTITION BY hostid, path, key_ ORDER BY CAST(itemid AS BIGINT)) rn FROM (
    SELECT *, unnest(list_distinct(regexp_extract_all(name || ' ' || key_ || ' ' || lastvalue, '{_PATH}', 1))) path FROM own) WHERE {_SAFE}) WHERE rn = 1""",
    ("own",),
)
PARTS["services_all"] = (SECTION_SQL["services"], ("own",))
PARTS["host_paths"] = ("SELECT system, role, host_ref, path, kind, item_key FROM resolved JOIN found_paths USING (hostid)", ("resolved", "found_paths"))
PARTS["dom_paths"] = (
    """SELECT system, role, host_ref, path, CASE WHEN regexp_matches(lower(path), '\\.(crt|pem|key|csr|pfx|p12|cer)$|ssl|cert|pki|ca|tls') THEN 'certificate_like' ELSE kind END kind, item_key, d AS domain, CASE d WHEN 'example.com' THEN 'first' WHEN 'example.org' THEN 'third' ELSE '' END account
    FROM (SELECT *, CASE WHEN ends_with(lower(host_ref), 'example.com') THEN 'example.com' WHEN ends_with(lower(host_ref), 'example.org') THEN 'example.org' ELSE '' END d FROM host_paths)""",
    ("host_paths",),
)
PARTS["known"] = (f"SELECT DISTINCT host, path, CASE WHEN kind = 'other' THEN {_FILE_KIND} ELSE kind END kind FROM found_paths JOIN hosts USING (hostid)", ("found_paths", "hosts"))
PARTS["verified"] = (f"SELECT host, path, {_FILE_KIND} kind, length(path) % 5 <> 0 there, length(path) % 3 = 0 dir FROM known", ("known",))


def _polynomial(powers: tuple[float, ...], x: str) -> str:
    out = repr(powers[0])
    for p in powers[1:]:
        out = f"({out} * {x} + {p!r})"
    return out


def _erfc(x: str) -> str:
    """erfc(x) of a column by the published approximation that the library uses too."""
    ratio = lambda of, y: f"{_polynomial(of[0], y)} / {_polynomial(of[1], y)}"
    y, q = f"abs({x})", f"({x} * {x})"
    tail = f"exp(-{q}) * CASE WHEN {y} <= {C.FAR} THEN {ratio(C.ERFC, y)} ELSE ({C.INVERSE_ROOT_PI!r} - {ratio(C.ERFC_FAR, f'(1 / {q})')} / {q}) / {y} END"
    return f"CASE WHEN {y} <= {C.NEAR} THEN 1 - {x} * {ratio(C.ERF, q)} WHEN {x} < 0 THEN 2 - {tail} ELSE {tail} END"


PARTS["chance"] = (
    f"""SELECT {SERIES}, h horizon_days, 1 - product(1 - least(greatest(0.5 * {_erfc("z")}, 0), 1)) prob
    FROM (SELECT *, (90 - p50) / greatest(greatest(p90 - p50, 0.5) / 1.2815515655446004, 0.25) / sqrt(2) z FROM naive) JOIN (SELECT unnest([30, 90, 180, 365]) h) ON horizon_day <= h GROUP BY ALL""",
    ("naive",),
)
PARTS["sure"] = (f"SELECT {SERIES}, wape, mae, pinball, calibration, {{}} sure FROM (SELECT DISTINCT {SERIES} FROM grid) LEFT JOIN backtest USING ({SERIES})", ("grid", "backtest"))
PARTS["probs"] = (f"SELECT *, prob * 100 raw, least(greatest(prob * (0.5 + 0.5 * sure / 100), 0), 1) * 100 adjusted FROM chance LEFT JOIN sure USING ({SERIES})", ("chance", "sure"))


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in PARTS[name][1]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in order) + "\n" + body if order else body


def r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


def ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


def day(c: str = "date") -> str:
    return f"CAST({c} AS VARCHAR) AS {c}"


_SUMMARY = "count(v) host_count, round(avg(v), 6) util_mean, round(quantile_cont(v, 0.5), 6) util_median, round(min(v), 6) util_min, round(max(v), 6) util_max, round(quantile_cont(v, 0.1), 6) util_p10, round(quantile_cont(v, 0.9), 6) util_p90"
_TREND = "count(DISTINCT hostid) host_count, round(avg(av), 6) util_avg_mean, round(quantile_cont(av, 0.5), 6) util_avg_median, round(min(lo), 6) util_min, round(max(hi), 6) util_max, round(quantile_cont(av, 0.1), 6) util_avg_p10, round(quantile_cont(av, 0.9), 6) util_avg_p90"
_CLIP = lambda x: f"least(greatest({x}, 0), 100)"
_RISKS = f"SELECT {SERIES}, point_count, {r('util_mean', 'util_std', 'p50', 'p95', 'p99', 'duty_cycle_80', 'duty_cycle_90', 'burstiness', 'volatility')}, cluster, overprovisioned FROM"
_DAYS = ", ".join(f"days_to_{t}_{c}" for c in ("p50", "p90", "p95") for t in (80, 90, 95))
_CONFIDENCE = "100 * (0.45 * coalesce(1 - least(greatest(wape, 0), 1.5) / 1.5, 0.5) + 0.25 * coalesce(1 - least(greatest(pinball, 0), 20) / 20, 0.5) + 0.30 * coalesce(1 - least(abs(calibration - 0.9), 0.5) / 0.5, 0.5))"
PARTS["sure"] = (PARTS["sure"][0].format(_CONFIDENCE), PARTS["sure"][1])
_WIDE = ", ".join(f"max(CASE WHEN horizon_days = {h} THEN adjusted END) p{h}" for h in (30, 90, 180, 365))
_BUCKET = "CASE WHEN basis <= 30 THEN 'critical_now' WHEN basis <= 90 THEN 'critical_soon' WHEN basis <= 180 THEN 'risk_6m' WHEN basis <= 365 THEN 'risk_12m' ELSE 'stable' END"
_TOP = "SELECT metric, hostid, host, status, basis days_to_90_basis FROM actions ORDER BY list_position(['critical', 'watch', 'stable', 'overprovisioned'], status), coalesce(basis, 1000000000), metric, host, hostid LIMIT 12"
_LINEAR = "SELECT metric, hostid, host, as_value, env_value, env_group, regr_slope(y, d) s, regr_intercept(y, d) c, max(d) l FROM (SELECT *, CAST(date - DATE '1970-01-01' AS DOUBLE) d FROM grid) GROUP BY ALL"
_F = {h: f"CASE WHEN hostid = '1' THEN 100 - (c + s * (l + {h})) ELSE c + s * (l + {h}) END" for h in (30, 90, 180, 365)}
_STATUSES = """SELECT lower(host) nhost, CASE WHEN k % 7 = 3 THEN ' Disabled ' WHEN status = '0' THEN 'Monitored' ELSE 'Not monitored' END status FROM hosts"""
_NHOSTS = "SELECT DISTINCT nhost FROM (" + _STATUSES + ") WHERE regexp_matches(lower(status), 'disabled|not monitored|unmonitored')"

SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "hosts_by_tag": ("SELECT hostid, host FROM hosts WHERE status = '0' AND (list_contains(tags, 'AS-1') OR list_contains(tags, 'AS-9'))", ("hosts",)),
    "hosts_by_tag_part": ("SELECT hostid, host FROM hosts WHERE status = '0' AND len(list_filter(tags, lambda t: contains(t, '9') OR contains(t, '-2'))) > 0", ("hosts",)),
    "host_scope": ("SELECT * FROM scope", ("scope",)),
    "select_cpu_items": ("SELECT * FROM cpu", ("cpu",)),
    "select_ram_items": ("SELECT * FROM ram", ("ram",)),
    "select_disk_items": ("SELECT * FROM disk", ("disk",)),
    "selection_report": ("SELECT * FROM selected", ("selected",)),
    "selected_counts": ("SELECT " + ", ".join(f"count(*) FILTER (metric = '{m}' AND source = '{x}') {m}_{x}{'s' if x == 'feature' else ''}" for m, x in (("cpu", "target"), ("ram", "target"), ("disk", "target"), ("ram", "feature"), ("disk", "feature"))) + ", count(*) FILTER (source = 'feature') feature_total FROM selected", ("selected",)),
    "normalize_trend": (f"SELECT itemid, {ts('clock')}, num, {r('value_min', 'value_avg', 'value_max')} FROM trend", ("trend",)),
    "points_in_window": ("SELECT itemid, count(*) n, strftime(max(clock), '%Y-%m-%d %H:%M:%S') AS last, round(avg(value_avg), 6) value_avg FROM trend WHERE clock BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2000-12-31' AND itemid IN (SELECT itemid FROM selected) GROUP BY itemid", ("trend", "selected")),
    "derive_history": ("SELECT itemid, count(*) n, 0 ns FROM trend WHERE clock >= TIMESTAMP '2001-07-01' - INTERVAL 30 DAY GROUP BY itemid", ("trend",)),
    "util_trend": (
        f"""SELECT metric, {ts('clock')}, hostid, host, as_value, env_value, env_group, itemid, num, round(CASE WHEN lo IS NULL THEN NULL ELSE {_CLIP('lo')} END, 6) util_min, round({_CLIP('a')}, 6) util_avg, round(CASE WHEN hi IS NULL THEN NULL ELSE {_CLIP('hi')} END, 6) util_max FROM (
        SELECT *, CASE WHEN transform = 'invert_100' THEN 100 - value_max ELSE value_min END lo, CASE WHEN transform = 'invert_100' THEN 100 - value_avg ELSE value_avg END a, CASE WHEN transform = 'invert_100' THEN 100 - value_min ELSE value_max END hi FROM trend JOIN selected USING (itemid) WHERE source = 'target')""",
        ("trend", "selected"),
    ),
    "util_history": (f"SELECT metric, {ts('clock')}, hostid, host, as_value, env_value, env_group, itemid, round({_CLIP('''CASE WHEN transform = 'invert_100' THEN 100 - value_avg ELSE value_avg END''')}, 6) utilization_pct FROM trend JOIN selected USING (itemid) WHERE source = 'target'", ("trend", "selected")),
    "feature_trend": ("SELECT metric, feature, entity, " + ts("clock") + ", hostid, host, as_value, itemid, num, " + ", ".join(f"round(CASE WHEN {c} IS NULL THEN NULL WHEN ends_with(feature, '_pct') THEN {_CLIP(c)} ELSE {c} END, 6) {c}" for c in ("value_min", "value_avg", "value_max")) + " FROM trend JOIN selected USING (itemid) WHERE source = 'feature'", ("trend", "selected")),
    "feature_history": (f"SELECT metric, feature, entity, {ts('clock')}, hostid, host, as_value, itemid, round(CASE WHEN ends_with(feature, '_pct') THEN {_CLIP('value_avg')} ELSE value_avg END, 6) AS value FROM trend JOIN selected USING (itemid) WHERE source = 'feature'", ("trend", "selected")),
    "attach_scope": ("SELECT hostid, itemid, coalesce(env_value, '') env_value, coalesce(env_group, 'non-prod') env_group FROM items LEFT JOIN scope USING (hostid)", ("items", "scope")),
    "history_summary_all": (f"SELECT metric, {ts('clock')}, {_SUMMARY} FROM util_h GROUP BY metric, util_h.clock", ("util_h",)),
    "history_summary_by_tag": (f"SELECT metric, as_value, {ts('clock')}, {_SUMMARY} FROM util_h GROUP BY metric, as_value, util_h.clock", ("util_h",)),
    "trend_summary_all": (f"SELECT metric, {ts('clock')}, {_TREND} FROM util_t GROUP BY metric, util_t.clock", ("util_t",)),
    "trend_summary_by_tag": (f"SELECT metric, as_value, {ts('clock')}, {_TREND} FROM util_t GROUP BY metric, as_value, util_t.clock", ("util_t",)),
    "scope_summaries": (
        " UNION ALL ".join(f"SELECT '{level}' AS level, metric, {a} AS as_value, {e} AS env_group, strftime(clock, '%Y-%m-%d %H:%M:%S') clock, {_SUMMARY} FROM util_h GROUP BY metric, util_h.clock{more}" for level, a, e, more in (("all", "''", "''", ""), ("tag", "as_value", "''", ", util_h.as_value"), ("scope", "as_value", "env_group", ", util_h.as_value, util_h.env_group"))),
        ("util_h",),
    ),
    "scope_trend_summaries": (
        " UNION ALL ".join(f"SELECT '{level}' AS level, metric, {a} AS as_value, {e} AS env_group, strftime(clock, '%Y-%m-%d %H:%M:%S') clock, {_TREND} FROM util_t GROUP BY metric, util_t.clock{more}" for level, a, e, more in (("all", "''", "''", ""), ("tag", "as_value", "''", ", util_t.as_value"), ("scope", "as_value", "env_group", ", util_t.as_value, util_t.env_group"))),
        ("util_t",),
    ),
    "tag_breakdown": (f"SELECT metric, as_value AS series, {ts('clock')}, round(avg(v), 6) util_mean FROM util_h GROUP BY metric, as_value, util_h.clock", ("util_h",)),
    "daily_p95": (f"SELECT {SERIES}, CAST(CAST(clock AS DATE) AS VARCHAR) date, round({_CLIP('quantile_cont(v, 0.95)')}, 6) target_p95 FROM util_h GROUP BY {SERIES}, CAST(clock AS DATE)", ("util_h",)),
    "risk_metrics": (f"{_RISKS} risk_events", ("risk_events",)),
    "risk_counts": ("SELECT " + ", ".join(f"count(*) FILTER (cluster = '{c}') cluster_{c}" for c in ("cold", "warm", "hot")) + ", count(*) FILTER (overprovisioned) overprovisioned_hosts FROM risk_events", ("risk_events",)),
    "host_count": ("SELECT count(DISTINCT hostid) host_count FROM util_h", ("util_h",)),
    "host_count_by_scope": ("SELECT as_value, env_group, count(DISTINCT hostid) host_count FROM util_h GROUP BY ALL", ("util_h",)),
    "metric_latest_status": (
        f"SELECT metric, util_mean, util_p90, {ts('clock')}, CASE WHEN util_p90 >= 90 THEN 'critical' WHEN util_mean >= 80 THEN 'high' ELSE 'normal' END state FROM (SELECT metric, clock, round(avg(v), 6) util_mean, round(quantile_cont(v, 0.9), 6) util_p90, row_number() OVER (PARTITION BY metric ORDER BY clock DESC) n FROM util_h GROUP BY metric, clock) WHERE n = 1",
        ("util_h",),
    ),
    "trend_week_delta": (
        """SELECT metric, round(a, 6) recent_7d, round(b, 6) prev_7d, round(a - b, 6) delta_pp, CASE WHEN a - b > 1 THEN 'up' WHEN a - b < -1 THEN 'down' ELSE 'flat' END state FROM (
        SELECT metric, count(*) n, avg(m) FILTER (i <= 7) a, avg(m) FILTER (i > 7) b FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY d DESC) i FROM (SELECT metric, CAST(clock AS DATE) d, avg(m) m FROM (SELECT metric, clock, avg(av) m FROM util_t GROUP BY ALL) GROUP BY ALL)) WHERE i <= 14 GROUP BY metric) WHERE n = 14""",
        ("util_t",),
    ),
    "metrics_union": ("SELECT DISTINCT metric FROM util_h", ("util_h",)),
    "heat_map": ("SELECT metric, host, CAST(date AS VARCHAR) date, round(m, 6) AS mean FROM (SELECT metric, host, CAST(clock AS DATE) date, avg(v) m, dense_rank() OVER (PARTITION BY metric ORDER BY host) n FROM util_h GROUP BY metric, host, CAST(clock AS DATE)) WHERE n <= 40", ("util_h",)),
    "daily_grid": (f"SELECT {SERIES}, {day()}, round(y + 1e-9, 6) y FROM grid", ("grid",)),
    "lag_features": (
        "SELECT metric, hostid, " + day() + ", round(y + 1e-9, 6) y, " + ", ".join(f"round({c} + 1e-9, 6) + 0.0 AS {c}" for c in [*[f"lag_{k}" for k in (1, 2, 3, 7, 14, 21, 28)], *[f"{a}_{w}" for w in (3, 7, 14) for a in ("mean", "std")], "dow_sin", "dow_cos"]) + " FROM (SELECT *, row_number() OVER o i, "
        + ", ".join(f"lag(y, {k}) OVER o lag_{k}" for k in (1, 2, 3, 7, 14, 21, 28)) + ", " + ", ".join(f"avg(y) OVER (PARTITION BY {SERIES} ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) mean_{w}, stddev_samp(y) OVER (PARTITION BY {SERIES} ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) std_{w}" for w in (3, 7, 14))
        + f", sin(2 * pi() * (isodow(date) - 1) / 7) dow_sin, cos(2 * pi() * (isodow(date) - 1) / 7) dow_cos FROM grid WINDOW o AS (PARTITION BY {SERIES} ORDER BY date)) WHERE i > 28",
        ("grid",),
    ),
    "seasonal_naive_forecast": (f"SELECT {SERIES}, {day()}, horizon_day, 'seasonal_naive' model, {r('p50', 'p90', 'p95')} FROM naive", ("naive",)),
    "robust_trend_backtest": (f"SELECT {SERIES}, 'robust_trend' model, round(wape, 6) wape, round(mae, 6) mae, round(pinball, 6) pinball_p90, round(calibration, 6) calibration_p90, CAST(coalesce(folds, 0) AS INTEGER) folds FROM (SELECT DISTINCT {SERIES} FROM grid) LEFT JOIN trend_backtest USING ({SERIES})", ("grid", "trend_backtest")),
    "seasonal_naive_backtest": (f"SELECT {SERIES}, 'seasonal_naive' model, round(wape, 6) wape, round(mae, 6) mae, round(pinball, 6) pinball_p90, round(calibration, 6) calibration_p90, coalesce(folds, 0) folds FROM (SELECT DISTINCT {SERIES} FROM grid) LEFT JOIN backtest USING ({SERIES})", ("grid", "backtest")),
    "days_to_threshold": (f"SELECT metric, hostid, env_value, env_group, {_DAYS}, " + ", ".join(day(f"date_90_{c}") for c in ("p50", "p90", "p95")) + " FROM crossing", ("crossing",)),
    "actions": (f"SELECT {SERIES}, cluster, overprovisioned, {r('p50', 'p95', 'p99', 'duty_cycle_80', 'duty_cycle_90', 'burstiness', 'volatility')}, {_DAYS}, risk_basis, basis days_to_90_basis, CAST(basis_date AS VARCHAR) crossing_date_90_basis, status, recommendation FROM actions", ("actions",)),
    "risk_probabilities": (
        f"""SELECT {SERIES}, horizon_days, CAST(90 AS DOUBLE) threshold, round(raw, 6) prob_cross_pct, round(adjusted, 6) prob_cross_adjusted_pct, round(sure, 6) confidence_index_pct, 'seasonal_naive' selected_model,
        round(wape, 6) wape, round(mae, 6) mae, round(pinball, 6) pinball_p90, round(calibration, 6) calibration_p90, CASE WHEN sure >= 75 THEN 'high' WHEN sure < 50 THEN 'low' ELSE 'medium' END confidence_level FROM probs""",
        ("probs",),
    ),
    "probability_wide": (f"SELECT {SERIES}, " + ", ".join(f"round(p{h}, 6) prob_cross_90_{h}d_pct" for h in (30, 90, 180, 365)) + f" FROM (SELECT {SERIES}, {_WIDE} FROM probs GROUP BY ALL)", ("probs",)),
    "complete_actions": (
        f"SELECT {SERIES}, cluster, overprovisioned, {r('p50', 'p95', 'p99', 'duty_cycle_80', 'duty_cycle_90', 'burstiness', 'volatility')}, {_DAYS}, risk_basis, basis days_to_90_basis, CAST(basis_date AS VARCHAR) crossing_date_90_basis, status, recommendation, round(c, 6) confidence_index_pct, "
        + ", ".join(f"round(p{h}, 6) prob_cross_90_{h}d_pct" for h in (30, 90, 180, 365))
        + f" FROM actions LEFT JOIN (SELECT {SERIES}, max(sure) c, {_WIDE} FROM probs GROUP BY ALL) USING ({SERIES})",
        ("actions", "probs"),
    ),
    "scope_conclusion": (
        f"""SELECT as_value, env_group, section_no, row_number() OVER (PARTITION BY as_value, env_group, section_no ORDER BY basis NULLS LAST, host, metric, hostid) line_no,
        '- ' || host || ' [' || upper(metric) || ']: to 90% ~ ' || coalesce(basis || ' d', 'n/a') || ', P(<= ' || hd || ' d)=' || coalesce(printf('%.1f', adjusted) || '%', 'n/a') || ', confidence=' || coalesce(printf('%.1f', sure) || '%', 'n/a') || ', status=' || status || ', recommendation=' || recommendation AS line FROM (
        SELECT a.*, list_position(['critical_now', 'critical_soon', 'risk_6m', 'risk_12m', 'stable', 'overprovisioned'], sect) section_no, CASE sect WHEN 'critical_now' THEN 30 WHEN 'critical_soon' THEN 90 WHEN 'risk_6m' THEN 180 ELSE 365 END hd
        FROM (SELECT *, unnest(list_filter([{_BUCKET}, CASE WHEN status = 'overprovisioned' THEN 'overprovisioned' END], lambda x: x IS NOT NULL)) sect FROM actions) a) q
        LEFT JOIN (SELECT {SERIES}, horizon_days hd, adjusted, sure FROM probs) USING ({SERIES}, hd)""",
        ("actions", "probs"),
    ),
    "confidence_index": (f"SELECT {SERIES}, round({_CONFIDENCE}, 6) confidence_index_pct, round(coalesce(wape, 10) + coalesce(pinball, 10) + coalesce(abs(calibration - 0.9), 1), 6) selection_score FROM (SELECT DISTINCT {SERIES} FROM grid) LEFT JOIN backtest USING ({SERIES})", ("grid", "backtest")),
    "horizon_buckets": ("SELECT as_value, env_group, count(*) total, " + ", ".join(f"count(*) FILTER ({_BUCKET} = '{b}') {b}" for b in ("critical_now", "critical_soon", "risk_6m", "risk_12m", "stable")) + ", count(*) FILTER (status = 'overprovisioned') overprovisioned FROM actions GROUP BY ALL", ("actions",)),
    "status_counts": ("SELECT as_value, env_group, status, count(*) n FROM actions GROUP BY ALL", ("actions",)),
    "top_k_actions": (_TOP, ("actions",)),
    "forecast_chart": (
        f"""SELECT kind, metric, hostid, {day()}, {r('actual', 'p50', 'p90', 'p95')}, round(c, 6) confidence_index_pct, CASE WHEN c >= 75 THEN 'high' WHEN c < 50 THEN 'low' WHEN c IS NOT NULL THEN 'medium' END confidence_level,
        round(p30, 6) prob_cross_90_30d_pct, round(p90_, 6) prob_cross_90_90d_pct, round(p180, 6) prob_cross_90_180d_pct, round(p365, 6) prob_cross_90_365d_pct FROM (
        SELECT 'actual' kind, metric, hostid, date, y actual, CAST(NULL AS DOUBLE) p50, CAST(NULL AS DOUBLE) p90, CAST(NULL AS DOUBLE) p95 FROM (SELECT *, max(date) OVER (PARTITION BY metric, hostid) l FROM grid) WHERE date >= l - 90
        UNION ALL SELECT 'forecast', metric, hostid, date, NULL, y, y, y FROM (SELECT *, max(date) OVER (PARTITION BY metric, hostid) l FROM grid) WHERE date = l
        UNION ALL SELECT 'forecast', metric, hostid, date, NULL, p50, p90, p95 FROM naive) SEMI JOIN ({_TOP}) USING (metric, hostid)
        LEFT JOIN (SELECT metric, hostid, max(sure) c, max(adjusted) FILTER (horizon_days = 30) p30, max(adjusted) FILTER (horizon_days = 90) p90_, max(adjusted) FILTER (horizon_days = 180) p180, max(adjusted) FILTER (horizon_days = 365) p365 FROM probs GROUP BY ALL) USING (metric, hostid)""",
        ("grid", "naive", "actions", "probs"),
    ),
    "action_labels": (
        f"""SELECT {SERIES}, upper(metric) metric_label, CASE status WHEN 'watch' THEN 'under watch' WHEN 'overprovisioned' THEN 'spare resources' ELSE status END status_label, CASE cluster WHEN 'hot' THEN 'hot (raised risk)' WHEN 'cold' THEN 'cold (low load)' ELSE 'warm (working range)' END cluster_label,
        CASE risk_basis WHEN 'p50' THEN 'by p50' ELSE 'by p90/p95 as hot' END basis_label, coalesce(basis || ' d', 'n/a') days_label FROM actions""",
        ("actions",),
    ),
    "scope_list": ("SELECT DISTINCT as_value, env_group, as_value as_slug FROM (SELECT as_value, env_group FROM util_h UNION ALL SELECT as_value, env_group FROM actions UNION ALL SELECT as_value, env_group FROM selected)", ("util_h", "actions", "selected")),
    "forecast_item_specs": ("SELECT * FROM specs", ("specs",)),
    "trigger_specs": ("SELECT * FROM triggers", ("triggers",)),
    "item_diff": ("SELECT * FROM item_diff", ("item_diff",)),
    "trigger_diff": ("SELECT * FROM trigger_diff", ("trigger_diff",)),
    "provision_counts": ("SELECT 'item' object_type, action, count(*) n FROM item_diff GROUP BY ALL UNION ALL SELECT 'trigger', action, count(*) FROM trigger_diff GROUP BY ALL", ("item_diff", "trigger_diff")),
    "linear_forecast": (f"SELECT {SERIES}, " + ", ".join(f"round({e}, 6) f{h}" for h, e in _F.items()) + f" FROM ({_LINEAR})", ("grid",)),
    "risk_windows": (f"SELECT {SERIES}, a AS risk_30d, b AND NOT a AS risk_90d, c2 AND NOT b AS risk_180d, d2 AND NOT c2 AS risk_365d FROM (SELECT *, {_F[30]} >= 45 a, {_F[90]} >= 45 b, {_F[180]} >= 45 c2, {_F[365]} >= 45 d2 FROM ({_LINEAR}))", ("grid",)),
    "host_tree": ("SELECT * FROM refs", ("refs",)),
    "resolve_hosts": ("SELECT * FROM resolved", ("resolved",)),
    "inv_paths": ("SELECT hostid, path, kind, item_key, left(lastvalue, 300) excerpt FROM found_paths", ("found_paths",)),
    "inv_summary": (
        "SELECT r.*, coalesce(n, 0) item_count, array_to_string(list_filter([" + ", ".join(f"CASE WHEN coalesce({c}, 0) > 0 THEN '{c}' END" for c in (*list(SECTION_SQL)[:5], "paths_found_in_items", "raw_service_related_items")) + "], lambda x: x IS NOT NULL), ', ') matched_sections, "
        + ", ".join(f"CASE WHEN r.hostid IS NOT NULL THEN coalesce({c}, 0) END {c}" for c in (*list(SECTION_SQL)[:5], "paths_found_in_items", "raw_service_related_items"))
        + " FROM resolved r LEFT JOIN (SELECT hostid, count(*) n FROM own GROUP BY ALL) USING (hostid) "
        + " ".join(f"LEFT JOIN (SELECT hostid, count(*) {c} FROM ({q}) GROUP BY hostid) USING (hostid)" for c, q in {**SECTION_SQL, "paths_found_in_items": "SELECT * FROM found_paths"}.items()),
        ("resolved", "own", "found_paths"),
    ),
    "domain_services": (
        """SELECT system, role, host_ref, unit, field, item_key, d AS domain, CASE d WHEN 'example.com' THEN 'first' WHEN 'example.org' THEN 'third' ELSE '' END account FROM (
        SELECT system, role, host_ref, value unit, detail field, item_key, CASE WHEN ends_with(lower(host_ref), 'example.com') THEN 'example.com' WHEN ends_with(lower(host_ref), 'example.org') THEN 'example.org' ELSE '' END d FROM resolved JOIN services_all USING (hostid))""",
        ("resolved", "services_all"),
    ),
    "domain_longest": (
        """SELECT *, CASE d WHEN 'ops.example.com' THEN 'second' WHEN 'example.org' THEN 'third' ELSE '' END account FROM (
        SELECT system, role, host_ref, CASE WHEN ends_with(lower(host_ref), '.ops.example.com') THEN 'ops.example.com' WHEN ends_with(lower(host_ref), '.example.org') THEN 'example.org' ELSE '' END d FROM resolved)""".replace("*, CASE d", "system, role, host_ref, d AS domain, CASE d"),
        ("resolved",),
    ),
    "host_labels": (
        """SELECT hostid, 'Web;t-base' templates, 'all;site ' || nk AS groups, array_to_string(list_sort(list_concat(list_transform(tags, lambda x: 'AS=' || x), ['ENV= ', 'ENV=' || CASE k % 4 WHEN 0 THEN 'prod' WHEN 1 THEN ' Prod ' ELSE 'dev' END])), ';') tags FROM hosts""",
        ("hosts",),
    ),
    "scan_errors": (
        """SELECT 'host' || s_suppkey host, 'report_host' || s_suppkey || '.txt' file, CASE WHEN s_suppkey % 11 = 3 THEN 'scan failed: exit code 255' WHEN s_suppkey % 5 = 0 THEN 'read error' WHEN s_suppkey % 5 = 1 THEN 'empty file' ELSE 'no unit found' END message
        FROM supplier WHERE s_suppkey % 11 = 3 OR s_suppkey % 5 < 3""",
        (),
    ),
    "domain_paths": ("SELECT * FROM dom_paths", ("dom_paths",)),
    "domain_dirs": (f"SELECT DISTINCT domain, account, host_ref host, system, role, kind, {_PARENT} AS directory FROM dom_paths", ("dom_paths",)),
    "path_kinds": (f"SELECT path, {_ITEM_KIND} item_kind, {_FILE_KIND} file_kind, {_DUMP_KIND} dump_kind, CASE {_FILE_KIND} WHEN 'other' THEN 'other' ELSE replace({_FILE_KIND}, '_file', '_dir') END dir_kind, {_PARENT} parent FROM (SELECT DISTINCT path FROM found_paths)", ("found_paths",)),
    "page_paths": (f"SELECT path, count(*) n FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(url, '{_PATH}', 1))) path FROM pages) WHERE {_SAFE} GROUP BY path", ()),
    "derived_paths": (
        f"""SELECT host, path, kind, 'inventory' AS source FROM known UNION ALL SELECT host, path, kind, 'systemd' FROM (SELECT host, unnest(['/usr/lib/systemd/system/app.service', '/etc/app/app.conf', '/opt/app' || k || '/env', '/usr/bin/tool' || k, '/usr/bin']) path,
        unnest(['config_file', 'config_file', 'data_file', 'binary_file', 'service_dir']) kind FROM hosts) d ANTI JOIN known USING (host, path)""",
        ("known", "hosts"),
    ),
    "verified_dirs": (f"SELECT DISTINCT host, CASE WHEN dir THEN path ELSE {_PARENT} END AS directory, CASE kind WHEN 'other' THEN 'other' ELSE replace(kind, '_file', '_dir') END kind FROM verified WHERE there", ("verified",)),
    "host_status": (_STATUSES, ("hosts",)),
    "unit_lists": (f"SELECT host_ref host, row_number() OVER (PARTITION BY host_ref ORDER BY unit) seq, unit FROM (SELECT DISTINCT host_ref, value unit FROM resolved JOIN services_all USING (hostid) WHERE coalesce(value, '') <> '' AND lower(host_ref) NOT IN ({_NHOSTS}))", ("resolved", "services_all", "hosts")),
    "text_units": (
        """SELECT host, unit, status, main_pid FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'app' || s_suppkey || '.ops.example.com' ELSE 'host' || s_suppkey END host, unnest(['nginx.service', 'app.service']) unit, unnest(['Active: inactive', 'Active: failed']) status, unnest(['', 'Main PID: ' || s_suppkey || ' (app)']) main_pid FROM supplier)""",
        (),
    ),
    "text_paths": (
        """SELECT host, u unit, kd kind, p path FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'app' || s_suppkey || '.ops.example.com' ELSE 'host' || s_suppkey END host,
        unnest(['nginx.service', 'nginx.service', 'nginx.service', 'nginx.service', 'nginx.service', 'nginx.service', 'nginx.service', 'nginx.service', 'app.service', 'app.service', 'app.service']) u,
        unnest(['exec', 'other', 'exec', 'config', 'unit_fragment', 'other', 'env_file', 'config', 'log', 'certificate', 'binary']) kd0,
        unnest(['exec', 'binary', 'exec', 'config', 'unit_fragment', 'other', 'env_file', 'config', 'log', 'certificate', 'binary']) kd,
        unnest(['/usr/sbin/nginx', '/usr/sbin/nginx', '/etc/nginx/my site.conf', '/etc/nginx/my site.conf', '/usr/lib/systemd/system/nginx.service', '/usr/lib/systemd/system/nginx.service', '/etc/sysconfig/nginx', '/etc/sysconfig/nginx', '/var/log/app' || s_suppkey || '/access.log', '/etc/ssl/certs/site.crt', '/opt/cache/x']) p FROM supplier)""",
        (),
    ),
    "text_dirs": (
        """SELECT host, kd kind, p AS directory FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'app' || s_suppkey || '.ops.example.com' ELSE 'host' || s_suppkey END host, unnest(['app_dir', 'app_dir', 'config_dir', 'config_dir', 'log_dir', 'certificate_dir']) kd,
        unnest(['/usr/sbin', '/etc/nginx', '/etc/nginx', '/etc/sysconfig', '/var/log/app' || s_suppkey, '/etc/ssl/certs']) p FROM supplier)""",
        (),
    ),
    "ingest_stream": (
        f"""SELECT * FROM (WITH points AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY itemid, clock ORDER BY num DESC, value_min DESC NULLS LAST, value_avg DESC NULLS LAST, value_max DESC NULLS LAST) i FROM trend) WHERE i = 1),
        turned AS (SELECT metric, hostid, t.clock, num, CASE WHEN transform = 'invert_100' THEN 100 - value_max ELSE value_min END lo, CASE WHEN transform = 'invert_100' THEN 100 - value_avg ELSE value_avg END av,
          CASE WHEN transform = 'invert_100' THEN 100 - value_min ELSE value_max END hi FROM points t JOIN selected s USING (itemid) WHERE source = 'target'),
        daily AS (SELECT metric, hostid, CAST(clock AS DATE) date, quantile_cont({_CLIP("av")}, 0.95) p FROM turned GROUP BY ALL)
        SELECT metric, hostid, n, hours, num, round(lo + 1e-9, 6) util_min, round(av + 1e-9, 6) util_avg, round(hi + 1e-9, 6) util_max, days, round(p + 1e-9, 6) target_p95
        FROM (SELECT metric, hostid, count(*) n, count(DISTINCT clock) AS hours, CAST(sum(num) AS BIGINT) num, avg({_CLIP("lo")}) FILTER (lo IS NOT NULL) lo, avg({_CLIP("av")}) av, avg({_CLIP("hi")}) FILTER (hi IS NOT NULL) hi FROM turned GROUP BY ALL)
        JOIN (SELECT metric, hostid, count(*) AS days, avg(p) p FROM daily GROUP BY ALL) USING (metric, hostid))""",
        ("trend", "selected"),
    ),
    "stored_points": (
        """SELECT 'point' kind, strftime(clock, '%Y-%m') AS key, count(*) n FROM trend WHERE clock BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2000-12-31 23:59:59' GROUP BY ALL
        UNION ALL SELECT 'error', 'value', count(*) FROM lineitem WHERE l_quantity IN (13, 14) HAVING count(*) > 0""",
        ("trend",),
    ),
}
_COUNTED = {"cpu_target_items": ("cpu", "target"), "ram_target_items": ("ram", "target"), "disk_target_items": ("disk", "target"), "ram_feature_items": ("ram", "feature"), "disk_feature_items": ("disk", "feature")}
SQL["conclusion"] = (
    "SELECT 'run' AS section, 'matched_hosts' AS key, CAST(count(DISTINCT hostid) AS VARCHAR) AS value FROM util_h"
    + "".join(f" UNION ALL SELECT 'selection', '{k}', CAST(count(*) FILTER (metric = '{m}' AND source = '{x}') AS VARCHAR) FROM selected" for k, (m, x) in _COUNTED.items())
    + " UNION ALL SELECT 'selection', 'feature_items_total', CAST(count(*) FILTER (source = 'feature') AS VARCHAR) FROM selected"
    + f""" UNION ALL SELECT metric, unnest(['latest_history_mean_pct', 'latest_history_p90_pct', 'status']), unnest([printf('%.2f', util_mean), printf('%.2f', util_p90), state]) FROM ({SQL["metric_latest_status"][0]})
    UNION ALL SELECT metric, unnest(['trend_recent_7d_mean_pct', 'trend_prev_7d_mean_pct', 'trend_delta_pp', 'trend_state']), unnest([printf('%.2f', recent_7d), printf('%.2f', prev_7d), printf('%.2f', delta_pp), state]) FROM ({SQL["trend_week_delta"][0]})
    UNION ALL SELECT 'risk', 'cluster_' || cluster, CAST(count(*) AS VARCHAR) FROM risk GROUP BY cluster UNION ALL SELECT 'risk', 'overprovisioned_hosts', CAST(count(*) FILTER (overprovisioned) AS VARCHAR) FROM risk
    UNION ALL SELECT 'actionable', 'status_' || status, CAST(count(*) AS VARCHAR) FROM actions GROUP BY status UNION ALL SELECT 'forecast', 'model_seasonal_naive', CAST(count(DISTINCT hostid) AS VARCHAR) FROM grid""",
    ("util_h", "util_t", "selected", "risk", "actions", "grid"),
)
for _name, _q in {"inv_services": "services", "inv_filesystems": "filesystems", "inv_devices": "block_devices", "inv_interfaces": "network_interfaces", "inv_ssl": "ssl_targets", "inv_raw": "raw_service_related_items"}.items():
    SQL[_name] = (f"SELECT * EXCLUDE (section) FROM ({SECTION_SQL[_q]})", ("own",))


_SECTION_ROWS = " UNION ALL ".join(f"SELECT * FROM ({q})" for q in SECTION_SQL.values()) + " UNION ALL SELECT hostid, 'paths_found_in_items' AS section, path AS value, kind AS detail, item_name, item_key, lastvalue, units, lastclock FROM found_paths"
SQL["inv_in_order"] = (
    f"""SELECT hostid, section, row_number() OVER (PARTITION BY hostid, section ORDER BY coalesce(a, 'None'), coalesce(b, 'None'), item_key, item_name, lastvalue, coalesce(value, ''), coalesce(detail, '')) seq, value, detail, item_name, item_key FROM (
    SELECT *, CASE WHEN section = 'raw_service_related_items' THEN item_name ELSE value END a, CASE WHEN section IN ('filesystems', 'block_devices') THEN detail ELSE item_key END b FROM ({_SECTION_ROWS}))""",
    ("own", "found_paths"),
)
_TABLES = {"selected_items": "selected", "host_risk_metrics": "risk", "actionable": "actions"}
SQL["run_context"] = (" UNION ALL ".join(f"""SELECT '{{"horizons": [30, 90, 180, 365], "threshold": 90.0}}' parameters, '{n}' AS name, count(*) n FROM {t}""" for n, t in _TABLES.items()), tuple(_TABLES.values()))
SQL["report_bundle"] = (" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) n, {k} AS columns FROM {t}" for (n, t), k in zip(_TABLES.items(), (13, 18, 29))), tuple(_TABLES.values()))
SQL["by_scope"] = (" UNION ALL ".join(f"SELECT '{n}' AS name, as_value as_slug, env_group, count(*) n FROM {t} GROUP BY ALL" for n, t in _TABLES.items()), tuple(_TABLES.values()))
_SCOPED = "as_value, env_group"
SQL["scope_facts"] = (
    f"SELECT {_SCOPED}, 'run' AS section, 'matched_hosts' AS key, CAST(count(DISTINCT hostid) AS VARCHAR) AS value FROM util_h GROUP BY {_SCOPED}"
    + "".join(f" UNION ALL SELECT {_SCOPED}, 'selection', '{k}', CAST(count(*) FILTER (metric = '{m}' AND source = '{x}') AS VARCHAR) FROM selected GROUP BY {_SCOPED}" for k, (m, x) in _COUNTED.items())
    + f" UNION ALL SELECT {_SCOPED}, 'selection', 'feature_items_total', CAST(count(*) FILTER (source = 'feature') AS VARCHAR) FROM selected GROUP BY {_SCOPED}"
    + f""" UNION ALL SELECT {_SCOPED}, metric, unnest(['latest_history_mean_pct', 'latest_history_p90_pct', 'status']), unnest([printf('%.2f', m), printf('%.2f', p), CASE WHEN p >= 90 THEN 'critical' WHEN m >= 80 THEN 'high' ELSE 'normal' END]) FROM (
      SELECT {_SCOPED}, metric, avg(v) m, quantile_cont(v, 0.9) p, row_number() OVER (PARTITION BY metric, {_SCOPED} ORDER BY clock DESC) n FROM util_h GROUP BY {_SCOPED}, metric, clock) WHERE n = 1
    UNION ALL SELECT {_SCOPED}, metric, unnest(['trend_recent_7d_mean_pct', 'trend_prev_7d_mean_pct', 'trend_delta_pp', 'trend_state']), unnest([printf('%.2f', a), printf('%.2f', b), printf('%.2f', a - b), CASE WHEN a - b > 1 THEN 'up' WHEN a - b < -1 THEN 'down' ELSE 'flat' END]) FROM (
      SELECT {_SCOPED}, metric, count(*) n, avg(m) FILTER (i <= 7) a, avg(m) FILTER (i > 7) b FROM (SELECT *, row_number() OVER (PARTITION BY metric, {_SCOPED} ORDER BY d DESC) i FROM (
        SELECT {_SCOPED}, metric, CAST(clock AS DATE) d, avg(m) m FROM (SELECT {_SCOPED}, metric, clock, avg(av) m FROM util_t GROUP BY ALL) GROUP BY ALL)) WHERE i <= 14 GROUP BY {_SCOPED}, metric) WHERE n = 14
    UNION ALL SELECT {_SCOPED}, 'risk', 'cluster_' || cluster, CAST(count(*) AS VARCHAR) FROM risk GROUP BY {_SCOPED}, cluster UNION ALL SELECT {_SCOPED}, 'risk', 'overprovisioned_hosts', CAST(count(*) FILTER (overprovisioned) AS VARCHAR) FROM risk GROUP BY {_SCOPED}
    UNION ALL SELECT {_SCOPED}, 'actionable', 'status_' || status, CAST(count(*) AS VARCHAR) FROM actions GROUP BY {_SCOPED}, status UNION ALL SELECT {_SCOPED}, 'forecast', 'model_seasonal_naive', CAST(count(DISTINCT hostid) AS VARCHAR) FROM grid GROUP BY {_SCOPED}""",
    ("util_h", "util_t", "selected", "risk", "actions", "grid"),
)


def oracle_sql() -> dict[str, str]:
    return {name: _with(body, *needs) for name, (body, needs) in SQL.items()}
