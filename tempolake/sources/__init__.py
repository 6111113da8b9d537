"""Where events come from and where raw events are kept."""
