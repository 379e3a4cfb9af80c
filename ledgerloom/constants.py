"""Names that records carry.  The namespace is this library's own and may be replaced where another is wanted."""

NAMESPACE = "LEDGERLOOM"
CONVERSATION_PROTOCOL = f"{NAMESPACE}/CONVERSATION/1"
MESSAGE_PROTOCOL = f"{NAMESPACE}/MESSAGE/1"
PROVENANCE_PROTOCOL = f"{NAMESPACE}/PROVENANCE/1"
TOMBSTONE_PROTOCOL = f"{NAMESPACE}/TOMBSTONE/1"
ADAPTER_PROTOCOL = f"{NAMESPACE}/ADAPTER/1"
