"""Input views, loaders, document readers, type maps and file sinks."""
