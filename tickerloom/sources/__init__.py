"""Where frames come from: message streams, stored tables, dimensions."""
