"""The cleaning chain on a file stream of landed raw records."""
