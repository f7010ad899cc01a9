"""The same checks over document streams."""
