"""Writers: replay-safe tables and topics."""
