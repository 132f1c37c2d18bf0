"""Sources and sinks: landed files, envelopes, pagers, archives and snapshots."""
