"""Rows of Bronze objects for tests: payloads from a sample's time and states."""

import datetime as dt
import uuid

from tessera.plans.pipeline import SilverTarget

START = dt.datetime(2025, 11, 3, 7, 15, 0)
DEVICE, OTHER_DEVICE, ELTEC_DEVICE = "001BC5A1B2C3", "B4A2EB0D0E0F", "4827E2010203"


def payload(minute=0, door=0, compressor=0, fan=0, buzzer=0):
    """Six bytes: epoch seconds, then the states at bits 36, 40, 42 and 44."""
    seconds = int((START + dt.timedelta(minutes=minute) - dt.datetime(1970, 1, 1)).total_seconds())
    return f"{seconds:08x}{door << 3:02x}{compressor << 7 | fan << 5 | buzzer << 3:02x}"


def event(extraction, number, *, device=DEVICE, technology="ImberaLink", firmware="126", kind="EVENTS", part=0, data=None):
    """One chunk row; by default a whole document, whose states depend on its number."""
    if data is None and kind:
        data = payload(13 * number, door=number % 2, compressor=(number + 1) % 2, buzzer=number % 3 == 0)
    return extraction, device, technology, None, firmware, number, kind, part if kind else None, data


def split(row, at):
    """The two chunk rows of a document's one."""
    return [(*row[:7], 0, row[8][:at]), (*row[:7], 1, row[8][at:])]


def new_target(workdir, name="t", **more):
    """A target with a table that no other test has."""
    return SilverTarget(silver_root=f"{workdir}/{name}-silver", table=f"silver.{name}_{uuid.uuid4().hex[:12]}", buckets=4, **more)
