"""The same results in SQL, written the plain way: full joins and ranked rows."""

# The event record over the driver's table; `events` is the table itself.
EVENT_SQL = """
ev AS (
  SELECT CAST(1 AS INT) AS version,
         ts AS timestamp,
         'bam_event' AS documentType,
         CASE event_type WHEN 'view' THEN 'ACTIVITY_START'
                         WHEN 'purchase' THEN 'ACTIVITY_END'
                         ELSE upper(event_type) END AS eventType,
         concat('host-', CAST(user_id % 4 AS VARCHAR)) AS technicalOrigin,
         concat('BO-', CAST(user_id % 10 AS VARCHAR)) AS businessOrigin,
         concat('process-', CAST(user_id % 5 AS VARCHAR)) AS businessProcessId,
         concat('process-', CAST(user_id % 5 AS VARCHAR)) AS businessProcessName,
         '1.0.0' AS businessProcessVersion,
         concat('activity-', CAST(user_id % 3 AS VARCHAR)) AS businessProcessActivityId,
         CASE WHEN k % 2 = 1 THEN concat('step-', CAST(user_id % 3 AS VARCHAR)) END AS businessProcessActivityName,
         concat(CAST(user_id AS VARCHAR), '-', CAST(k AS VARCHAR)) AS businessProcessInstanceId,
         CASE WHEN event_type = 'purchase' THEN CAST(round(value * 100) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS durationInMillis,
         CASE WHEN k % 25 <> 0 THEN concat(CAST(user_id AS VARCHAR), '-', CAST(k AS VARCHAR)) END AS spp_trace_wf_id,
         CASE WHEN event_type = 'purchase' AND k % 3 <> 0
              THEN CASE WHEN k % 2 = 0 THEN 'YES' ELSE 'NO' END END AS ipCheckResult
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) x
)"""

# JSON messages carry milliseconds.
EVENT_MS_SQL = EVENT_SQL.replace(
    "ts AS timestamp,", "date_trunc('millisecond', ts) AS timestamp,"
)

COMMON = [
    "version", "timestamp", "documentType", "eventType", "technicalOrigin", "businessOrigin",
    "businessProcessId", "businessProcessName", "businessProcessVersion",
    "businessProcessActivityId", "businessProcessActivityName", "businessProcessInstanceId",
]


def _renamed(prefix: str, columns: list[str]) -> str:
    return ", ".join(f"{c} AS {prefix}{c[0].upper()}{c[1:]}" for c in columns)


def _names(prefix: str, columns: list[str]) -> str:
    return ", ".join(f"{prefix}{c[0].upper()}{c[1:]}" for c in columns)


def _plain(columns: list[str]) -> str:
    return ", ".join(f"e{c[0].upper()}{c[1:]} AS {c}" for c in columns)


TRACED = [*COMMON, "spp_trace_wf_id"]
S_COLS = _names("s", TRACED)
E_COLS = _names("e", TRACED) + ", durationInMillis, ipCheckResult"
SAME_KEY = """sBusinessProcessName = eBusinessProcessName
  AND sBusinessProcessActivityId = eBusinessProcessActivityId
  AND sSpp_trace_wf_id = eSpp_trace_wf_id"""
FINISHED = f"{_plain(TRACED)}, durationInMillis, ipCheckResult"
CUT = "TIMESTAMP '2024-01-16 00:00:00'"


def _sides(suffix: str, condition: str) -> str:
    return f"""
s{suffix} AS (SELECT {_renamed("s", TRACED)}, 1 AS s_here FROM ev
  WHERE eventType = 'ACTIVITY_START' AND {condition}),
e{suffix} AS (SELECT {_renamed("e", TRACED)}, durationInMillis, ipCheckResult, 1 AS e_here FROM ev
  WHERE eventType = 'ACTIVITY_END' AND {condition}),
c{suffix} AS (SELECT * FROM s{suffix} FULL OUTER JOIN e{suffix} ON {SAME_KEY})"""


BASE = f"WITH {EVENT_SQL},{_sides('', 'TRUE')}"
KPI = """
k AS (SELECT *, CAST(5000 AS BIGINT) AS kpiThresholdValue,
  CASE WHEN durationInMillis > 5000 THEN 'NOK' ELSE 'OK' END AS kpiStatusText,
  CASE WHEN durationInMillis > 5000 THEN 1 ELSE 0 END AS kpiStatusValue FROM f)"""
# Finished ends, once each, with the number of their starts.
ENDS_ONCE = f"""
n AS (SELECT sBusinessProcessName AS k0, sBusinessProcessActivityId AS k1, sSpp_trace_wf_id AS k2,
  count(*) AS matches FROM s GROUP BY ALL),
f AS (SELECT {FINISHED}, matches FROM e JOIN n
  ON eBusinessProcessName = k0 AND eBusinessProcessActivityId = k1 AND eSpp_trace_wf_id = k2)"""
WITH_FINISHED = f"{BASE},{ENDS_ONCE},{KPI}"
DOC_COLUMNS = [
    '"@version"', '"@timestamp"', "documentType", "eventType", "technicalOrigin", "businessOrigin",
    "businessProcessId", "businessProcessName", "businessProcessVersion",
    "businessProcessActivityId", "businessProcessActivityName", "businessProcessInstanceId",
    "durationInMillis", "id", "spp_trace_wf_id", "ipCheckResult", "kpiThresholdValue",
    "kpiStatusText", "kpiStatusValue",
]
DOCS = ", ".join(DOC_COLUMNS)
DOCUMENT = """
d AS (SELECT version AS "@version", timestamp AS "@timestamp", 'correlated_event' AS documentType,
  eventType, technicalOrigin, businessOrigin, businessProcessId, businessProcessName,
  businessProcessVersion, businessProcessActivityId, businessProcessActivityName,
  businessProcessInstanceId, durationInMillis,
  concat_ws('_', businessProcessName, businessProcessActivityName, spp_trace_wf_id) AS id,
  spp_trace_wf_id, ipCheckResult, CAST(kpiThresholdValue AS VARCHAR) AS kpiThresholdValue,
  kpiStatusText, CAST(kpiStatusValue AS VARCHAR) AS kpiStatusValue, matches FROM k)"""
WITH_DOCS = f"{WITH_FINISHED},{DOCUMENT}"
# The same from JSON messages: what a job leaves, wherever its batches were cut.
BASE_MS = f"WITH {EVENT_MS_SQL},{_sides('', 'TRUE')}"
WITH_DOCS_MS = f"{BASE_MS},{ENDS_ONCE},{KPI},{DOCUMENT}"
DOC_ORDER = ", ".join(
    ['"@timestamp" DESC NULLS LAST', "durationInMillis DESC NULLS LAST"]
    + [f"{c} ASC NULLS LAST" for c in DOC_COLUMNS if c not in ('"@timestamp"', "durationInMillis", "id")]
)



def _two_batches(event_sql: str) -> str:
    return f"""WITH {event_sql},{_sides('1', f'timestamp < {CUT}')},{_sides('2', f'timestamp >= {CUT}')},
pending AS (SELECT {S_COLS} FROM c1 WHERE e_here IS NULL),
orphans AS (SELECT {E_COLS} FROM c2 WHERE s_here IS NULL)"""


TWO_BATCHES = _two_batches(EVENT_SQL)
DAILY = """
dd AS (SELECT *, CAST("@timestamp" AS DATE) AS doc_date,
  concat('bam-', strftime("@timestamp", '%Y.%m.%d')) AS target FROM d)"""


def _per_trace(prefix: str, absent: str) -> str:
    process, trace = f"{prefix}BusinessProcessName", f"{prefix}Spp_trace_wf_id"
    return (
        f"{BASE} SELECT {process}, {trace}, count(*) AS count FROM c "
        f"WHERE {absent} IS NULL GROUP BY {process}, {trace}"
    )


RULES = """
rules AS (
  SELECT concat('process-', CAST(p AS VARCHAR)) AS businessProcessName,
         concat('phase-', CAST(p AS VARCHAR), '-', CAST(a AS VARCHAR)) AS businessProcessPhaseName,
         concat('activity-', CAST(a AS VARCHAR)) AS startActivityId, 'ACTIVITY_START' AS startType,
         concat('activity-', CAST(a AS VARCHAR)) AS endActivityId, 'ACTIVITY_END' AS endType,
         CAST(100 AS BIGINT) AS threshold
  FROM range(5) x(p), range(3) y(a)
),
ps AS (SELECT ev.*, r.businessProcessPhaseName, r.threshold FROM ev JOIN rules r
  ON ev.businessProcessName = r.businessProcessName
  AND ev.businessProcessActivityId = r.startActivityId AND ev.eventType = r.startType),
pe AS (SELECT ev.*, r.businessProcessPhaseName FROM ev JOIN rules r
  ON ev.businessProcessName = r.businessProcessName
  AND ev.businessProcessActivityId = r.endActivityId AND ev.eventType = r.endType)"""
SIDE = [c for c in COMMON if c != "businessProcessInstanceId"]


def _from(alias: str, prefix: str, columns: list[str]) -> str:
    return ", ".join(f"{alias}.{c} AS {prefix}{c[0].upper()}{c[1:]}" for c in columns)


PHASE_OUT = f"""businessProcessInstanceId, {_names("s", SIDE)}, {_names("e", SIDE)},
  businessProcessPhaseName, id, durationInMillis"""
PHASE_END_OUT = f"""businessProcessInstanceId, sTimestamp, {_names("e", SIDE)},
  businessProcessPhaseName, id, durationInMillis, matches"""
PHASE_KPI = "kpiThresholdValue, kpiStatusText, kpiStatusValue, documentType"


def _measured_sql(condition: str) -> str:
    return f"""
pm AS (SELECT a.businessProcessInstanceId, {_from("a", "s", SIDE)}, {_from("b", "e", SIDE)},
  a.durationInMillis AS sDurationInMillis, b.durationInMillis AS eDurationInMillis,
  a.spp_trace_wf_id AS sTrace, b.spp_trace_wf_id AS eTrace, b.ipCheckResult AS eIp,
  a.businessProcessPhaseName,
  concat_ws('_', a.businessProcessPhaseName, a.businessProcessInstanceId) AS id,
  date_diff('millisecond', date_trunc('millisecond', a.timestamp),
            date_trunc('millisecond', b.timestamp)) AS durationInMillis, a.threshold
  FROM ps a JOIN pe b ON a.businessProcessPhaseName = b.businessProcessPhaseName
  AND a.businessProcessInstanceId = b.businessProcessInstanceId {condition}),
p AS (SELECT *, threshold AS kpiThresholdValue,
  CASE WHEN durationInMillis > threshold THEN 'NOK' ELSE 'OK' END AS kpiStatusText,
  CASE WHEN durationInMillis > threshold THEN 1 ELSE 0 END AS kpiStatusValue,
  'phase_event' AS documentType FROM pm)"""


WITH_PHASES = f"WITH {EVENT_SQL},{RULES},{_measured_sql('')}"


def _phase_order(prefix: str) -> str:
    rest = [c for c in SIDE if c != "timestamp"]
    columns = _names(prefix, rest).split(", ") + [f"{prefix}DurationInMillis"]
    return ", ".join(
        [f"{prefix}Timestamp DESC NULLS LAST"] + [f"{c} ASC NULLS LAST" for c in columns]
    )


# The alarm's subject and, in ORACLE, its message text.
def _alarms(page_ids: int, docs: str = WITH_DOCS) -> str:
    """Alarm rows; pages by the first 60 bits of the id's md5."""
    return f"""{docs},
v AS (SELECT businessProcessName, businessProcessActivityName, id, sum(matches) AS n FROM d
  WHERE kpiStatusText = 'NOK' GROUP BY ALL),
w AS (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY businessProcessName, businessProcessActivityName)
  / {page_ids}.0) AS BIGINT) AS pages,
  CAST(sum(n) OVER (PARTITION BY businessProcessName, businessProcessActivityName) AS BIGINT) AS allViolations FROM v),
x AS (SELECT *, CAST(concat('0x', substr(md5(id), 1, 15)) AS BIGINT) % pages + 1 AS page FROM w),
alarms AS (SELECT concat('[BAM, alarm!] for Process Name [', businessProcessName, ']') AS subject,
  businessProcessName AS processName, businessProcessActivityName AS phaseName, page, pages,
  string_agg(id, ' ' ORDER BY id) AS processInstanceIds,
  string_agg(CAST(n AS VARCHAR), ' ' ORDER BY id) AS occurrences,
  CAST(sum(n) AS BIGINT) AS violations, allViolations, CAST(5000 AS BIGINT) AS threshold
  FROM x GROUP BY businessProcessName, businessProcessActivityName, page, pages, allViolations)"""


# Each phase end once, measured from the latest start of its instance.
PHASE_ENDS = f"""
pl AS (SELECT businessProcessPhaseName AS phase, businessProcessInstanceId AS instance, threshold,
  max(timestamp) AS sTimestamp, count(*) AS matches FROM ps GROUP BY ALL),
pq AS (SELECT b.businessProcessInstanceId, sTimestamp, {_from("b", "e", SIDE)}, b.businessProcessPhaseName,
  concat_ws('_', b.businessProcessPhaseName, b.businessProcessInstanceId) AS id,
  date_diff('millisecond', date_trunc('millisecond', sTimestamp),
            date_trunc('millisecond', b.timestamp)) AS durationInMillis, matches, threshold
  FROM pe b JOIN pl ON phase = b.businessProcessPhaseName AND instance = b.businessProcessInstanceId),
px AS (SELECT * EXCLUDE (threshold), threshold AS kpiThresholdValue,
  CASE WHEN durationInMillis > threshold THEN 'NOK' ELSE 'OK' END AS kpiStatusText,
  CASE WHEN durationInMillis > threshold THEN 1 ELSE 0 END AS kpiStatusValue,
  'phase_event' AS documentType FROM pq)"""
CROSS_EVENT_SQL = EVENT_SQL.replace("CAST(user_id % 3 AS VARCHAR)) AS businessProcessActivityId",
                                    "CAST(event_id % 3 AS VARCHAR)) AS businessProcessActivityId")
CROSS_RULES = RULES.replace("concat('activity-', CAST(a AS VARCHAR)) AS endActivityId",
                            "concat('activity-', CAST((p * 3 + a + 1) % 3 AS VARCHAR)) AS endActivityId")

SPOILT = """
m AS (SELECT CASE k % 10
    WHEN 0 THEN concat('not json ', props)
    WHEN 1 THEN ''
    WHEN 2 THEN concat('{"@version":"x', CAST(event_id AS VARCHAR), '","@timestamp":"2024-01-01T00:00:00Z"}')
    WHEN 3 THEN concat('{"eventType":"', event_type, '"}') END AS value,
  CASE k % 10 WHEN 0 THEN 'malformed' WHEN 1 THEN 'malformed' WHEN 2 THEN 'number' WHEN 3 THEN 'timestamp' END AS reason
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) x)"""

ORACLE = {
    "q_parse_events": f"""WITH {EVENT_SQL}
        SELECT * REPLACE (date_trunc('millisecond', timestamp) AS timestamp) FROM ev""",
    "q_parse_rejects": f"WITH {SPOILT} SELECT value, reason FROM m WHERE reason IS NOT NULL",
    "q_raw_records": """SELECT CAST(user_id % 8 AS INT) AS partition, event_id AS "offset",
        props AS value FROM events""",
    "q_phase_rules": f"""WITH {EVENT_SQL},{RULES}
        SELECT r.*, (SELECT count(*) FROM ps WHERE ps.businessProcessPhaseName = r.businessProcessPhaseName) AS starts,
               (SELECT count(*) FROM pe WHERE pe.businessProcessPhaseName = r.businessProcessPhaseName) AS ends
        FROM rules r""",
    "q_start_events": f"{BASE} SELECT {S_COLS} FROM s",
    "q_end_events": f"{BASE} SELECT {E_COLS} FROM e",
    "q_correlated": f"""WITH {EVENT_SQL},
        a AS (SELECT * FROM ev WHERE eventType IN ('ACTIVITY_START', 'ACTIVITY_END')),
        m AS (SELECT eventType AS t, businessProcessName AS k0, businessProcessActivityId AS k1, spp_trace_wf_id AS k2,
          count(*) AS n, max(timestamp) AS last FROM a GROUP BY ALL)
        SELECT a.*, coalesce(n, 0) AS matches, last AS partnerTimestamp FROM a LEFT JOIN m ON t <> eventType
          AND k0 = businessProcessName AND k1 = businessProcessActivityId AND k2 = spp_trace_wf_id""",
    "q_classified": f"""WITH {EVENT_SQL},
        a AS (SELECT * FROM ev WHERE eventType IN ('ACTIVITY_START', 'ACTIVITY_END'))
        SELECT a.*, (SELECT count(*) FROM a b WHERE b.eventType <> a.eventType
            AND b.businessProcessName = a.businessProcessName
            AND b.businessProcessActivityId = a.businessProcessActivityId
            AND b.spp_trace_wf_id = a.spp_trace_wf_id) AS matches FROM a""",
    "q_finished_events": f"{WITH_FINISHED} SELECT * FROM f",
    "q_starts_without_end": f"{BASE} SELECT {S_COLS} FROM c WHERE e_here IS NULL",
    "q_ends_without_start": f"{BASE} SELECT {E_COLS} FROM c WHERE s_here IS NULL",
    "q_kpi_status": f"{WITH_FINISHED} SELECT * FROM k",
    "q_kpi_violations": f"{WITH_FINISHED} SELECT * FROM k WHERE kpiStatusText = 'NOK'",
    "q_violation_count": f"""{WITH_FINISHED} SELECT CAST(coalesce(sum(matches), 0) AS BIGINT) AS violations
        FROM k WHERE kpiStatusText = 'NOK'""",
    "q_documents": f"{WITH_DOCS} SELECT {DOCS}, matches FROM d",
    "q_documents_latest": f"""{WITH_DOCS} SELECT {DOCS} FROM d
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY {DOC_ORDER}) = 1""",
    "q_daily_documents": f"""{WITH_DOCS},{DAILY} SELECT {DOCS}, doc_date, target FROM dd
        QUALIFY row_number() OVER (PARTITION BY doc_date, id ORDER BY {DOC_ORDER}) = 1""",
    "q_iso_timestamps": f"""WITH {EVENT_SQL} SELECT businessProcessInstanceId, eventType,
        strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS isoTimestamp FROM ev""",
    "q_finished_per_trace": f"""{WITH_FINISHED} SELECT businessProcessName, spp_trace_wf_id,
        CAST(sum(matches) AS BIGINT) AS count FROM f GROUP BY businessProcessName, spp_trace_wf_id""",
    "q_open_per_trace": _per_trace("s", "e_here"),
    "q_orphans_per_trace": _per_trace("e", "s_here"),
    "q_group_counts": f"""{WITH_FINISHED},{_sides('1', f'timestamp < {CUT}')},{_sides('2', f'timestamp >= {CUT}')},
        g AS (SELECT 'finished' AS kind, businessProcessName AS p, spp_trace_wf_id AS t FROM f
          UNION ALL SELECT 'open', sBusinessProcessName, sSpp_trace_wf_id FROM c WHERE e_here IS NULL
          UNION ALL SELECT 'orphan', eBusinessProcessName, eSpp_trace_wf_id FROM c WHERE s_here IS NULL
          UNION ALL SELECT 'resolved', o.eBusinessProcessName, o.eSpp_trace_wf_id
            FROM (SELECT * FROM c1 WHERE e_here IS NULL) q JOIN (SELECT * FROM c2 WHERE s_here IS NULL) o
            ON q.sBusinessProcessName = o.eBusinessProcessName
            AND q.sBusinessProcessActivityId = o.eBusinessProcessActivityId
            AND q.sSpp_trace_wf_id = o.eSpp_trace_wf_id)
        SELECT kind, count(*) AS groups FROM (SELECT DISTINCT kind, p, t FROM g) h GROUP BY kind""",
    "q_alarm_ids": f"{WITH_DOCS} SELECT id, matches FROM d WHERE kpiStatusText = 'NOK'",
    "q_alarms": f"{_alarms(1000)} SELECT * FROM alarms",
    "q_alarm_pages": f"{_alarms(4)} SELECT * FROM alarms",
    "q_alarm_messages": f"""{_alarms(1000)}
        SELECT subject, page, concat('Subject: ', subject, chr(10), chr(10), 'The business process ', processName,
          ' has generated the following alarm:', chr(10), chr(10), repeat('-', 42), chr(10), chr(10),
          'Process Name         : ', processName, chr(10),
          'Activity Name        : ', coalesce(phaseName, ''), chr(10),
          'Ids                  : ', processInstanceIds, chr(10),
          'KPI Threshold Limit  : ', CAST(threshold AS VARCHAR), chr(10), chr(10), repeat('-', 42), chr(10), chr(10),
          'This message was delivered to you by BAM, alarm!') AS message FROM alarms""",
    "q_resolve_pending": f"""{TWO_BATCHES},
        n AS (SELECT sBusinessProcessName AS k0, sBusinessProcessActivityId AS k1, sSpp_trace_wf_id AS k2,
          count(*) AS matches FROM pending GROUP BY ALL)
        SELECT {FINISHED}, matches FROM orphans JOIN n
          ON eBusinessProcessName = k0 AND eBusinessProcessActivityId = k1 AND eSpp_trace_wf_id = k2""",
    "q_still_pending": f"""{TWO_BATCHES} SELECT {S_COLS} FROM pending
        WHERE NOT EXISTS (SELECT 1 FROM orphans WHERE {SAME_KEY})""",
    "q_unresolved_ends": f"""{TWO_BATCHES} SELECT {E_COLS} FROM orphans
        WHERE NOT EXISTS (SELECT 1 FROM pending WHERE {SAME_KEY})""",
    "q_phase_events": f"""WITH {EVENT_SQL},{RULES}
        SELECT 's' AS side, * EXCLUDE (threshold) FROM ps UNION ALL BY NAME SELECT 'e' AS side, * FROM pe""",
    "q_phases": f"WITH {EVENT_SQL},{RULES},{PHASE_ENDS} SELECT {PHASE_END_OUT} FROM px",
    "q_phases_cross": f"""WITH {CROSS_EVENT_SQL},{CROSS_RULES},{PHASE_ENDS}
        SELECT {PHASE_END_OUT}, {PHASE_KPI} FROM px""",
    "q_phase_kpi": f"""WITH {EVENT_SQL},{RULES},{PHASE_ENDS}
        SELECT id, durationInMillis, matches, {PHASE_KPI} FROM px""",
    "q_phases_latest": f"""{WITH_PHASES} SELECT {PHASE_OUT}, {PHASE_KPI} FROM p
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_phase_order("e")}, {_phase_order("s")}) = 1""",
    "q_stream_correlated": f"""WITH {EVENT_MS_SQL},
        a AS (SELECT * FROM ev WHERE eventType IN ('ACTIVITY_START', 'ACTIVITY_END')),
        m AS (SELECT eventType AS t, businessProcessName AS k0, businessProcessActivityId AS k1, spp_trace_wf_id AS k2,
          count(*) AS n, max(timestamp) AS last FROM a GROUP BY ALL)
        SELECT a.*, coalesce(n, 0) AS matches, last AS partnerTimestamp FROM a LEFT JOIN m ON t <> eventType
          AND k0 = businessProcessName AND k1 = businessProcessActivityId AND k2 = spp_trace_wf_id""",
    "q_stream_per_trace": f"""{BASE_MS},{ENDS_ONCE},
        g AS (SELECT businessProcessName, spp_trace_wf_id, matches AS finished, 0 AS open, 0 AS orphan FROM f
          UNION ALL SELECT sBusinessProcessName, sSpp_trace_wf_id, 0, 1, 0 FROM c WHERE e_here IS NULL
          UNION ALL SELECT eBusinessProcessName, eSpp_trace_wf_id, 0, 0, 1 FROM c WHERE s_here IS NULL)
        SELECT businessProcessName, spp_trace_wf_id, CAST(sum(finished) AS BIGINT) AS finished,
          CAST(sum(open) AS BIGINT) AS open, CAST(sum(orphan) AS BIGINT) AS orphan FROM g GROUP BY ALL""",
    "q_stream_key_totals": f"""WITH {EVENT_MS_SQL}
        SELECT businessProcessName, businessProcessActivityId, spp_trace_wf_id,
          count(*) FILTER (eventType = 'ACTIVITY_START') AS starts, count(*) FILTER (eventType = 'ACTIVITY_END') AS ends,
          max(timestamp) FILTER (eventType = 'ACTIVITY_START') AS lastStart,
          max(timestamp) FILTER (eventType = 'ACTIVITY_END') AS lastEnd
        FROM ev WHERE eventType IN ('ACTIVITY_START', 'ACTIVITY_END') AND spp_trace_wf_id IS NOT NULL GROUP BY ALL""",
    "q_stream_documents": f"""{WITH_DOCS_MS},{DAILY} SELECT {DOCS}, doc_date, target FROM dd
        QUALIFY row_number() OVER (PARTITION BY doc_date, id ORDER BY {DOC_ORDER}) = 1""",
    "q_stream_pending": f"{BASE_MS} SELECT {S_COLS} FROM c WHERE e_here IS NULL",
    "q_stream_orphans": f"{BASE_MS} SELECT {E_COLS} FROM c WHERE s_here IS NULL",
    "q_stream_alarms": f"{_alarms(1000, WITH_DOCS_MS)} SELECT * FROM alarms",
    "q_stream_phases": f"""WITH {EVENT_MS_SQL},{RULES},{_measured_sql('')}
        SELECT {PHASE_OUT}, {PHASE_KPI} FROM p
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_phase_order("e")}, {_phase_order("s")}) = 1""",
}
