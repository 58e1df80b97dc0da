"""Dispatch, decoding, flattening and audit (FIXTURES 2a-2c; H12)."""

import datetime as dt

import pytest

from tessera.operators import audit_reason, decodable_chunks, decode_audit, decode_records, resolve_technology, stored_layouts
from tessera.operators import decode
from tessera.operators.decode import LAYOUT


def _doc(ble="126", type_="EVENTS", payload="000f424008a8", tech="ImberaLink", device="B4A2EB428B04"):
    return ("extraction-test-001", device, tech, None, ble, 1, type_, payload)


def test_decodes_an_unencrypted_126_document(documents_df):
    records = decode_records(documents_df([_doc()])).collect()
    assert records, "expected flattened state records"
    assert any(r["value"] == 1.0 for r in records)
    # 0x000f4240 = 1,000,000 epoch seconds
    assert all(r["timestamp"] == dt.datetime(1970, 1, 12, 13, 46, 40) for r in records)
    # byte 4 = 0x08 (door), byte 5 = 0xa8 (compressor, fan, buzzer)
    assert {r["name"]: r["value"] for r in records} == {
        "door_state": 1.0, "compressor_state": 1.0, "fan_state": 1.0, "buzzer_state": 1.0}
    assert {(r["technology"], r["device_id"], r["extraction_id"]) for r in records} == {
        ("ImberaLink", "B4A2EB428B04", "extraction-test-001")}


def test_off_bits_give_zero_rows(documents_df):
    # compressor OFF -> ON -> OFF over three samples (end-to-end fixture 1c)
    docs = documents_df([_doc(payload=p) for p in ("6a18a5000000", "6a18b3100080", "6a18c1200000")])
    rows = decode_records(docs).where("name = 'compressor_state'").orderBy("timestamp").collect()
    assert [r["value"] for r in rows] == [0.0, 1.0, 0.0]
    assert rows[0]["timestamp"] == dt.datetime(2026, 5, 28, 20, 26, 40)


def test_unknown_firmware_yields_no_records(documents_df):
    assert decode_records(documents_df([_doc(ble="not-a-number")])).count() == 0


def test_document_without_type_or_payload_yields_no_records(documents_df):
    assert decode_records(documents_df([_doc(type_=None, payload=None)])).count() == 0


def test_other_technologies_have_no_layout(documents_df):
    assert decode_records(documents_df([_doc(tech="ELTEC"), _doc(tech="Villa")])).count() == 0


def test_bad_payload_is_rejected_not_read_as_zero(documents_df):
    docs = documents_df([_doc(payload="zz0f424008a8"), _doc(payload="000f424008a800"), _doc(payload="00")])
    assert decode_records(docs).count() == 0
    assert {r["decode_reason"] for r in audit_reason(docs).collect()} == {"bad_payload"}


def test_audit_reasons(documents_df):
    docs = documents_df([
        _doc(),
        _doc(type_=None, payload=None),
        ("e", "D", "ImberaLink", None, "126", 1, "EVENTS", None),
        _doc(ble="136"),
        _doc(payload="xx"),
        (None, "D", "ImberaLink", None, "126", 1, "EVENTS", "000f424008a8"),
    ])
    counts = {r["decode_reason"]: r["documents"] for r in decode_audit(docs).collect()}
    assert counts == {"ok": 1, "no_type": 1, "no_payload": 1, "no_layout": 1, "bad_payload": 1, "no_id": 1}


def test_technology_is_resolved_before_dispatch(documents_df):
    # Reported 'Softel' with an ImberaLink MAC decodes; an ELTEC MAC does not.
    docs = documents_df([_doc(tech="Softel"), _doc(tech="Softel", device="3CA551AABBCC")])
    records = decode_records(resolve_technology(docs)).collect()
    assert {r["device_id"] for r in records} == {"B4A2EB428B04"}
    assert {r["technology"] for r in records} == {"ImberaLink"}


def test_layout_rows_decode_any_bit_slice(documents_df):
    # A made-up layout for another technology: 12-bit field at bit 4, 3-bit field at bit 45,
    # byte-spanning 10-bit field at bit 36 (payload 0x0ABC_0000_5A7D).
    fields = [("ELTEC", "9", "EVENTS", 6, "twelve", 4, 12),
              ("ELTEC", "9", "EVENTS", 6, "three", 45, 3),
              ("ELTEC", "9", "EVENTS", 6, "ten", 36, 10)]
    payload = "0abc00005a7d"
    docs = documents_df([("e", "3CA551000001", "ELTEC", None, "9", 1, "EVENTS", payload)])
    got = {r["name"]: r["value"] for r in decode_records(docs, fields).collect()}
    value = int(payload, 16)

    def bits(offset, width):
        return (value >> (48 - offset - width)) & ((1 << width) - 1)

    assert got == {"twelve": float(bits(4, 12)), "three": float(bits(45, 3)), "ten": float(bits(36, 10))}
    assert got["twelve"] == float(0xABC)


def _layouts(spark, *rows):
    return spark.createDataFrame(list(rows), LAYOUT)


STORED = [("ELTEC", "9", None, "EVENTS", 8, "low", 32, 4), ("ELTEC", "9", None, "EVENTS", 8, "high", 36, 28),
          ("Villa", "2", "mac", "EVENTS", 5, "one", 39, 1), ("Villa", "2", "serial", "EVENTS", 6, "two", 32, 16)]


def test_stored_layouts_are_chosen_by_all_four_keys(spark, documents_df):
    docs = documents_df([("a", "D", "ELTEC", "mac", "9", 1, "EVENTS", "0000000a" + "5000000f"), ("b", "D", "ELTEC", None, "9", 1, "EVENTS", "0000000a" + "a0000001"),
                         ("c", "D", "Villa", "mac", "2", 1, "EVENTS", "0000000b" + "01"), ("d", "D", "Villa", "serial", "2", 1, "EVENTS", "0000000c" + "0102"),
                         ("e", "D", "Villa", None, "2", 1, "EVENTS", "0000000c" + "0102"), ("f", "D", "Villa", "serial", "2", 1, "START", "0000000c" + "0102"),
                         ("g", "D", "Villa", "mac", "2", 1, "EVENTS", "0000000c" + "0102")])
    layouts = stored_layouts(_layouts(spark, *STORED))
    got = {(r["extraction_id"], r["name"], r["value"]) for r in decode_records(docs, layouts).collect()}
    assert got == {("a", "low", 5.0), ("a", "high", 15.0), ("b", "low", 10.0), ("b", "high", 1.0), ("c", "one", 1.0), ("d", "two", 258.0)}
    audited = audit_reason(docs, layouts)
    reasons = {r["extraction_id"]: (r["decode_reason"], r["decoded_fields"]) for r in audited.collect()}
    assert reasons == {"a": ("ok", 2), "b": ("ok", 2), "c": ("ok", 1), "d": ("ok", 1), "e": ("no_layout", 0), "f": ("no_layout", 0), "g": ("bad_payload", 0)}
    assert {(r["extraction_id"], r["name"], r["value"]) for r in decode_records(audited, layouts).collect()} == got
    plan = decode_records(docs, layouts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2


def test_chunks_of_stored_layouts_go_before_the_shuffle(spark, chunks_df):
    chunks = chunks_df([(e, "AABBCC000001", "Villa", kind, "2", 1, "EVENTS", 0, "00") for e, kind in (("x", "mac"), ("y", "other"), ("z", None))])
    assert [r["extraction_id"] for r in decodable_chunks(chunks, stored_layouts(_layouts(spark, *STORED))).collect()] == ["x"]


def test_many_layouts_are_not_broadcast(spark, documents_df, monkeypatch):
    monkeypatch.setattr(decode, "BROADCAST_ROWS", 3)
    docs = documents_df([("a", "D", "ELTEC", "mac", "9", 1, "EVENTS", "0000000a" + "5000000f")])
    df = decode_records(docs, stored_layouts(_layouts(spark, *STORED)))
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
    assert {(r["name"], r["value"]) for r in df.collect()} == {("low", 5.0), ("high", 15.0)}


@pytest.mark.parametrize("row, fault", [
    (("ELTEC", None, None, "EVENTS", 8, "x", 64, 1), "a column is null"),
    (("ELTEC", "9", None, "EVENTS", 8, "x", 63, 2), "bits outside the payload"),
    (("ELTEC", "9", None, "EVENTS", 8, "x", -1, 2), "bits outside the payload"),
    (("Villa", "3", None, "EVENTS", 16, "x", 40, 0), "the width is not 1 to 60 bits"),
    (("Villa", "3", None, "EVENTS", 16, "x", 40, 61), "the width is not 1 to 60 bits"),
    (("Villa", "3", None, "EVENTS", 16, "x", 31, 1), "bits of the sample time"),
    (("ELTEC", "9", None, "EVENTS", 8, "x", 35, 1), "bits of another field"),
    (("Villa", "2", "mac", "EVENTS", 6, "x", 40, 1), "payload sizes differ"),
    (("Villa", "2", "serial", "EVENTS", 6, "two", 32, 16), "bits of another field"),
    (("Villa", "2", None, "EVENTS", 6, "x", 40, 1), "layouts for any and for one id type"),
])
def test_faulty_layouts_are_refused(spark, row, fault):
    with pytest.raises(ValueError, match=fault):
        stored_layouts(_layouts(spark, *STORED, row))
