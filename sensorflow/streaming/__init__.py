"""Starting, stopping and sinking streams."""
