"""File sources and sinks, and the versioned lake."""
