from strandweave.streaming.items import item_bridge, item_keys, write_item_bridge
from strandweave.streaming.keys import first_keys, list_items
from strandweave.streaming.loads import load_stream
from strandweave.streaming.totals import latest_totals, running_totals, write_totals
from strandweave.streaming.updates import changes, current_totals, vacuum_changes, write_changes

__all__ = ["changes", "current_totals", "first_keys", "item_bridge", "item_keys", "latest_totals", "list_items", "load_stream", "running_totals", "vacuum_changes", "write_changes", "write_item_bridge", "write_totals"]
