"""Tables, dumps and size-limited messages."""

from offerloom.sinks.messages import (
    popularity_message,
    publishable,
    schedule_message,
    to_messages,
    update_message,
)
from offerloom.sinks.tables import (
    load_dump,
    write_found_missing,
    write_offer_dump,
    write_offers,
)

__all__ = [name for name in dir() if not name.startswith("_")]
