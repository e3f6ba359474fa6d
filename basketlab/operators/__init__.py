"""basketlab.operators"""
