"""Paths that several test modules use."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
