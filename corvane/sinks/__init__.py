"""Writers, one action per output."""
