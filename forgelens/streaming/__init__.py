"""The continuous leg: messages in, classified records out."""
