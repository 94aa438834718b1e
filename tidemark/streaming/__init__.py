"""Starting, resuming and running a capture job; state tables fed by a stream."""
