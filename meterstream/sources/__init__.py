"""Sources: driver tables, the readings view, topic/replay streams, training files, stored results."""
