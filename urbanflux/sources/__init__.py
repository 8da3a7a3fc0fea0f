"""Everything that reads or writes: tables, streams, landing files, calendars."""
