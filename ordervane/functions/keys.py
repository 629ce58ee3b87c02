"""Row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What keeps keys from order ids and from hashes apart from event ids.
ORDER_PREFIX, HASH_PREFIX, EVENT_PREFIX = "order:", "hash:", "event:"


def order_key(event_id: Column, order_id: Column, fields: list[Column]) -> Column:
    """The event id, else the order id, else a hash of the whole event.

    A blank id counts as missing. Keys from order ids and hashes have a prefix, and so
    has an event id that begins like one of them: keys of different kinds never meet.
    The hash is the same on every run, so loading an event again updates its row and
    adds none.
    """
    event, order = (F.when(F.trim(c) != "", c) for c in (event_id, order_id))
    like_prefix = F.lit(False)
    for prefix in (ORDER_PREFIX, HASH_PREFIX, EVENT_PREFIX):
        like_prefix |= event.startswith(prefix)
    whole = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return F.coalesce(
        F.when(like_prefix, F.concat(F.lit(EVENT_PREFIX), event)).otherwise(event),
        F.concat(F.lit(ORDER_PREFIX), order),
        F.concat(F.lit(HASH_PREFIX), F.sha2(whole, 256)),
    )
