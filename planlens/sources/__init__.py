"""Reading landed data, writing published layers."""
