"""Writers, bounded and per micro-batch."""
