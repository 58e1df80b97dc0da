"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: the payload is read as one 48-bit
integer and each field is a single shifted bit, technology is a left join on a
VALUES table, replacement is a window ``max``. Views ``events`` etc. are
registered by the caller.
"""

from __future__ import annotations

# Fixed values repeated for the oracle: MAC prefix table and the 126 EVENTS fields
# as (name, bit counted from the most significant bit of the 48-bit payload).
_MAC_VALUES = ("('001BC5','ImberaLink'),('B4A2EB','ImberaLink'),('3CA551','ELTEC'),('00E44C','ELTEC'),"
               "('F412FA','ELTEC'),('7CDFA1','ELTEC'),('4827E2','ELTEC')")
_FIELD_VALUES = "('door_state',36),('compressor_state',40),('fan_state',42),('buzzer_state',44)"

BRONZE_CHUNKS = """
bronze_chunks as (
  with d as (
    select event_id, user_id, p.pfx || lpad(hex(user_id), 6, '0') as mac,
      lpad(lower(hex(cast(floor(epoch(ts)) as bigint))), 8, '0') || case when event_id % 2 = 1 then '08' else '00' end
        || case cast(event_id % 8 as integer) when 0 then '00' when 1 then '80' when 2 then '20' when 3 then 'a0'
           when 4 then '08' when 5 then '88' when 6 then '28' else 'a8' end as whole
    from events join (values (0,'001BC5'),(1,'B4A2EB'),(2,'3CA551'),(3,'00E44C'),(4,'F412FA'),
                             (5,'7CDFA1'),(6,'4827E2'),(7,'AABBCC'),(8,'DDEEFF')) p(i, pfx) on user_id % 9 = p.i),
  k as (
    select 'ext-' || cast(user_id as varchar) as extraction_id,
      case when event_id % 31 = 30 then null
        when user_id % 5 = 1 then lower(substr(mac, 1, 2) || ':' || substr(mac, 3, 2) || ':' || substr(mac, 5, 2) || ':'
          || substr(mac, 7, 2) || ':' || substr(mac, 9, 2) || ':' || substr(mac, 11, 2))
        when user_id % 5 = 2 then lower(substr(mac, 1, 2) || '-' || substr(mac, 3, 2) || '-' || substr(mac, 5, 2) || '-'
          || substr(mac, 7, 2) || '-' || substr(mac, 9, 2) || '-' || substr(mac, 11, 2))
        else mac end as id_controller,
      case user_id % 4 when 0 then 'Softel' when 1 then 'ELTEC' when 2 then 'Villa' end as technology,
      cast(null as varchar) as id_type,
      case event_id % 10 when 0 then '136' when 1 then 'not-a-number' else '126' end as ble_version,
      cast(event_id as integer) as document_sequence,
      case when event_id % 17 = 0 then null else 'EVENTS' end as type,
      case when event_id % 13 = 12 then null when event_id % 19 = 18 then 'zz' || substr(whole, 3)
        when event_id % 23 = 22 then substr(whole, 1, 10) else whole end as payload,
      event_id % 41 = 40 as one, event_id % 3 = 0 as three
    from d)
  select extraction_id, id_controller, technology, id_type, ble_version, document_sequence, type,
    case when type is null or one then null else c.i end as chunk_index,
    case when type is null then null when one then payload when c.i = 0 then substr(payload, 1, 4)
      when c.i = 2 then substr(payload, 9) when three then substr(payload, 5, 4) else substr(payload, 5) end
      as data_chunk_hex
  from k cross join (values (2),(0),(1)) c(i)
  where c.i = 0 or (type is not null and not one and (c.i = 1 or three))
)"""

BRONZE_DELIVERIES = """
bronze_deliveries as (
  select c.*, 1 as delivery_seq, 'telemetry/extraction_id=' || extraction_id || '/d1.parquet' as object_key
  from bronze_chunks c
  union all
  select c.*, 2, 'telemetry/extraction_id=' || extraction_id || '/d2.parquet'
  from bronze_chunks c
  where cast(substr(extraction_id, 5) as integer) % 3 = 0 and document_sequence % 2 = 0
  union all
  select distinct extraction_id, id_controller, technology, id_type, '126', 0, cast(null as varchar),
    cast(null as integer), cast(null as varchar), 2, 'telemetry/extraction_id=' || extraction_id || '/d2.parquet'
  from bronze_chunks
  where cast(substr(extraction_id, 5) as integer) % 3 = 1
)"""

_DOC_KEYS = "extraction_id, id_controller, technology, id_type, ble_version, document_sequence, type"


def _documents(source: str, extra: str = "") -> str:
    """Reassembled documents with resolved technology, from a chunk CTE."""
    return f"""
documents as (
  select {_DOC_KEYS}{extra},
    string_agg(data_chunk_hex, '' order by chunk_index) as payload_hex
  from {source}
  group by {_DOC_KEYS}{extra}
),
resolved as (
  select d.*, d.technology as reported_technology,
    coalesce(m.tech, case when d.technology in ('ImberaLink','ELTEC','Villa') then d.technology end,
             'ImberaLink') as resolved_technology
  from documents d
  left join (values {_MAC_VALUES}) m(pfx, tech)
    on upper(substr(replace(replace(d.id_controller, ':', ''), '-', ''), 1, 6)) = m.pfx
)"""


def _records(extra: str = "") -> str:
    return f"""
records as (
  select f.name,
    cast(((try_cast('0x' || r.payload_hex as bigint) >> (47 - f.bit)) & 1) as double) as value,
    epoch_ms(try_cast('0x' || substr(r.payload_hex, 1, 8) as bigint) * 1000) as timestamp,
    r.resolved_technology as technology, r.id_controller as device_id, r.extraction_id{extra}
  from resolved r cross join (values {_FIELD_VALUES}) f(name, bit)
  where r.type = 'EVENTS' and r.ble_version = '126' and r.resolved_technology = 'ImberaLink'
    and r.payload_hex is not null and regexp_full_match(r.payload_hex, '[0-9a-fA-F]{{12}}')
    and r.extraction_id is not null and r.id_controller is not null
)"""


def _safe(col: str) -> str:
    return (f"case when trim({col}) = '' then 'unknown' else "
            f"replace(replace(replace(replace(trim({col}), '/', '_'), '\\', '_'), ' ', '_'), ':', '') end")


_NOTIFICATIONS = """
notes as (
  select event_id as notification_id,
    case when event_id % 23 = 0 then 'not json' when event_id % 29 = 0 then '{}' else
      '{"EventName":"x","Records":[{"eventName":"s3:ObjectRemoved:Delete","s3":{"bucket":{"name":"bronze"},"object":{"key":"telemetry%2Fgone.parquet"}}},{"eventName":"'
      || case event_id % 5 when 0 then 's3:ObjectRemoved:Delete' else 's3:ObjectCreated:Put' end
      || '","s3":{"bucket":{"name":"bronze"},"object":{"size":5,"key":"'
      || case event_id % 7 when 0 then 'other' else 'telemetry' end
      || '%2Fdevice%3D' || cast(user_id as varchar)
      || case event_id % 3 when 0 then '' else '%2Fextraction_id%3Dext-' || cast(user_id as varchar) end
      || '%2Ffile' || case event_id % 11 when 0 then '.metadata.json' else '.parquet' end || '"}}}]}' end as payload
  from events
),
parsed as (
  select notification_id,
    json_transform(payload, '{"Records":[{"eventName":"VARCHAR","s3":{"bucket":{"name":"VARCHAR"},"object":{"key":"VARCHAR"}}}]}') as n
  from notes where json_valid(payload)
),
firsts as (
  select notification_id,
    list_filter(n.Records, lambda x: starts_with(x.eventName, 's3:ObjectCreated:')
      and contains(url_decode(replace(coalesce(x.s3.object.key, ''), '+', '%20')), 'telemetry/')
      and ends_with(url_decode(replace(coalesce(x.s3.object.key, ''), '+', '%20')), '.parquet'))[1] as rec
  from parsed
)"""

ORACLE: dict[str, str] = {
    "notifications_qualified": f"""
with {_NOTIFICATIONS.strip()}
select notification_id, rec.s3.bucket.name as bucket, k as object_key,
  coalesce(nullif(regexp_extract(k, 'extraction_id=([^/]+)/', 1), ''), k) as correlation_id
from (select notification_id, rec, url_decode(replace(coalesce(rec.s3.object.key, ''), '+', '%20')) as k
      from firsts where rec is not null)""",

    "technology_resolved": f"""
with {BRONZE_CHUNKS.strip()},
devices as (select distinct id_controller, technology from bronze_chunks)
select d.id_controller, d.technology as reported_technology,
  upper(substr(replace(replace(d.id_controller, ':', ''), '-', ''), 1, 6)) as mac_prefix,
  coalesce(m.tech, case when d.technology in ('ImberaLink','ELTEC','Villa') then d.technology end,
           'ImberaLink') as technology
from devices d left join (values {_MAC_VALUES}) m(pfx, tech)
  on upper(substr(replace(replace(d.id_controller, ':', ''), '-', ''), 1, 6)) = m.pfx""",

    "documents_reassembled": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()}
select {_DOC_KEYS}, payload_hex from documents""",

    "telemetry_decoded": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()}
select * from records""",

    "decode_audit": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()}
select case
    when extraction_id is null or id_controller is null then 'no_id'
    when type is null then 'no_type'
    when payload_hex is null then 'no_payload'
    when not (resolved_technology = 'ImberaLink' and ble_version = '126' and type = 'EVENTS') then 'no_layout'
    when not regexp_full_match(payload_hex, '[0-9a-fA-F]{{12}}') then 'bad_payload'
    else 'ok' end as decode_reason,
  count(*) as documents
from resolved group by 1""",

    "silver_day_counts": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()}
select {_safe('technology')} as technology, {_safe('device_id')} as device_id,
  cast(year(timestamp) as integer) as year, cast(month(timestamp) as integer) as month,
  cast(day(timestamp) as integer) as day, {_safe('extraction_id')} as extraction_id, count(*) as n_records
from records group by all""",

    "silver_prefixes": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()}
select distinct extraction_id,
  's3://silver/telemetry/technology=' || {_safe('technology')} || '/device_id=' || {_safe('device_id')} || '/'
    as silver_prefix
from records""",

    "last_delivery_wins": f"""
with {BRONZE_CHUNKS.strip()},
{BRONZE_DELIVERIES.strip()},
{_documents('bronze_deliveries', ', object_key, delivery_seq').strip()},
{_records(', r.object_key, r.delivery_seq').strip()}
select name, value, timestamp, technology, device_id, extraction_id, object_key
from (select *, max(delivery_seq) over (partition by technology, device_id, extraction_id) as latest
      from records)
where delivery_seq = latest""",

    "telemetry_upserted": f"""
with {BRONZE_CHUNKS.strip()},
{BRONZE_DELIVERIES.strip()},
{_documents('bronze_deliveries', ', object_key, delivery_seq').strip()},
{_records(', r.delivery_seq').strip()},
second as (select * from records where delivery_seq = 2)
select name, value, timestamp, technology, device_id, extraction_id from records r1
where delivery_seq = 1 and not exists (
  select 1 from second s where s.technology = r1.technology and s.device_id = r1.device_id
    and s.extraction_id = r1.extraction_id)
union all
select name, value, timestamp, technology, device_id, extraction_id from second""",

    "object_outcomes": f"""
with {BRONZE_CHUNKS.strip()},
{BRONZE_DELIVERIES.strip()},
{_documents('bronze_deliveries', ', object_key, delivery_seq').strip()},
{_records(', r.object_key').strip()},
per_doc as (
  select object_key, count(*) as n_documents,
    (min(id_controller) = max(id_controller) and min(extraction_id) = max(extraction_id)) as single_device
  from documents group by object_key),
per_rec as (
  select object_key, count(*) as n_records, min(technology) as tech, min(device_id) as device
  from records group by object_key)
select d.object_key, d.n_documents, coalesce(r.n_records, 0) as n_records,
  case when coalesce(r.n_records, 0) > 0 then 'processed' else 'empty' end as status,
  case when coalesce(r.n_records, 0) > 0 then
    's3://silver/telemetry/technology=' || {_safe('r.tech')} || '/device_id=' || {_safe('r.device')} || '/'
  end as silver_prefix,
  coalesce(d.single_device, true) as single_device
from per_doc d left join per_rec r on d.object_key = r.object_key""",

    "silver_roundtrip": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()}
select *, cast(year(timestamp) as integer) as year, cast(month(timestamp) as integer) as month,
  cast(day(timestamp) as integer) as day
from records""",

    "stream_availablenow": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()}
select * from records""",

    "silver_redelivered": f"""
with {BRONZE_CHUNKS.strip()},
{BRONZE_DELIVERIES.strip()},
{_documents('bronze_deliveries', ', object_key, delivery_seq').strip()},
{_records(', r.delivery_seq').strip()},
second as (select * from records where delivery_seq = 2)
select name, value, timestamp, technology, device_id, extraction_id from records r1
where delivery_seq = 1 and not exists (
  select 1 from second s where s.technology = r1.technology and s.device_id = r1.device_id
    and s.extraction_id = r1.extraction_id and cast(s.timestamp as date) = cast(r1.timestamp as date))
union all
select name, value, timestamp, technology, device_id, extraction_id from second""",

    "reprocess_outcomes": f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()},
per_doc as (select extraction_id, cast(substr(extraction_id, 5) as bigint) as no, count(*) as docs from documents group by 1, 2),
per_rec as (select extraction_id, count(*) as recs from records group by 1)
select d.extraction_id,
  case when no % 7 = 0 then 'unreadable' when r.recs > 0 then 'processed' else 'empty' end as status,
  case when no % 7 = 0 then 0 else docs end as n_documents,
  case when no % 7 = 0 then 0 else coalesce(r.recs, 0) end as n_records,
  no % 7 = 0 as has_error
from per_doc d left join per_rec r using (extraction_id)
union all
select extraction_id, 'missing', 0, 0, true from per_doc where no % 5 = 0""",
}
# Same results by other ways: the interrupted and the named table hold what the plain one does, and
# damaged re-deliveries leave the table as it was.
ORACLE["upsert_after_interruption"] = ORACLE["catalog_roundtrip"] = ORACLE["telemetry_upserted"]
ORACLE["object_integrity"] = ORACLE["telemetry_decoded"]

ORACLE["redelivered_objects"] = f"""
with {BRONZE_CHUNKS.strip()},
{_documents('bronze_chunks').strip()},
{_records().strip()},
objects as (select extraction_id, cast(substr(extraction_id, 5) as bigint) as no,
  exists (select 1 from records r where r.extraction_id = b.extraction_id) as decoded
  from (select distinct extraction_id from bronze_chunks) b)
select extraction_id, case no % 14 when 7 then 5 when 0 then 2 else 1 end as deliveries,
  case when no % 14 = 7 then 'missing' when decoded then 'processed' else 'empty' end as status, no % 14 = 7 as dead
from objects"""

ORACLE["notification_audit"] = f"""
with {_NOTIFICATIONS.strip()}
select case when not json_valid(payload) then 'malformed' when payload = '{{}}' then 'empty' else 'valid' end as status, count(*) as notifications
from notes group by 1"""

ORACLE["notifications_all_records"] = r"""
with keys as (
  select event_id as notification_id, unnest(['telemetry%2Fdevice%3D' || cast(user_id as varchar) || '%2Fa+b%2Ffile.parquet', 'telemetry%2F100%zz.parquet',
    'telemetry%2Fextraction_id%3Dext-' || cast(user_id as varchar) || '%2Ffile' || case event_id % 2 when 0 then '.parquet' else '.metadata.json' end]) as key
  from events where event_id % 7 <> 0),
decoded as (
  select notification_id, url_decode(replace(key, '+', '%20')) as object_key from keys
  where not contains(regexp_replace(key, '%[0-9A-Fa-f]{2}', '', 'g'), '%'))
select notification_id, 'bronze' as bucket, object_key, coalesce(nullif(regexp_extract(object_key, 'extraction_id=([^/]+)/', 1), ''), object_key) as correlation_id
from decoded where contains(object_key, 'telemetry/') and ends_with(object_key, '.parquet')"""

ORACLE["silver_odd_ids"] = f"""
with odd as (
  select event_id, case event_id % 6 when 0 then 'a/' || user_id when 1 then 'a\\' || user_id when 2 then 'a b' || user_id when 3 then ' a:' || user_id || ' ' when 4 then '  ' end as device_id,
    case event_id % 3 when 0 then 'Imbera Link' when 1 then ':' else 'EL/TEC' end as technology,
    epoch_ms(cast(floor(epoch(ts)) as bigint) * 1000 + event_id % 1000) as time
  from events),
safe as (select event_id, time, case when device_id is null then 'unknown' else {_safe('device_id')} end as device_dir, {_safe('technology')} as technology_dir from odd)
select event_id, device_dir, 's3://silver/telemetry/technology=' || technology_dir || '/device_id=' || device_dir || '/' as silver_prefix,
  cast(year(time) as integer) as year, cast(month(time) as integer) as month, cast(day(time) as integer) as day
from safe"""

ORACLE["telemetry_by_layouts"] = f"""
with {BRONZE_CHUNKS.strip()},
typed_chunks as (
  select * replace (case document_sequence % 3 when 0 then 'short' when 1 then 'long' end as id_type) from bronze_chunks),
{_documents('typed_chunks').strip()},
fields(firmware, for_type, name, bit, width) as (
  select '126', null, f.name, f.bit, 1 from (values {_FIELD_VALUES}) f(name, bit)
  union all values ('136', 'short', 'mode', 35, 3), ('136', 'short', 'level', 40, 8))
select f.name, cast((try_cast('0x' || r.payload_hex as bigint) >> (48 - f.bit - f.width)) & ((1 << f.width) - 1) as double) as value,
  epoch_ms(try_cast('0x' || substr(r.payload_hex, 1, 8) as bigint) * 1000) as timestamp,
  r.resolved_technology as technology, r.id_controller as device_id, r.extraction_id
from resolved r join fields f on r.ble_version = f.firmware and (f.for_type is null or f.for_type = r.id_type)
where r.type = 'EVENTS' and r.resolved_technology = 'ImberaLink' and regexp_full_match(r.payload_hex, '[0-9a-fA-F]{{12}}')
  and r.extraction_id is not null and r.id_controller is not null"""

ORACLE["decode_counters"] = f"""
with audit as ({ORACLE['decode_audit']}),
decoded as ({ORACLE['telemetry_decoded']})
select decode_reason, documents, (select count(*) from decoded) as n_records from audit"""
