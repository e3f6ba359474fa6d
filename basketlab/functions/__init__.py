"""basketlab.functions"""
